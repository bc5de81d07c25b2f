"""Personal data: fixed rules, and spans added by weak supervision.

The fixed rules find emails, addresses, cards and phones. Besides, every long number and every key-like token is a
candidate on which labelers vote: shapes (regular expressions), known beginnings (gazetteer), nearby words and
neighbouring characters (context), digits and variety (content). Expectation-maximisation estimates how often each
labeler says what about a personal and an ordinary candidate; the posteriors train a logistic classifier on features of
the span; the classifier decides. Votes and features take few values, so all documents are reduced to the counts of
their patterns (`PATTERNS` at most) before anything is fitted, whatever the size of the corpus.
"""

from __future__ import annotations

from functools import partial
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.texts import as_row, running_sums, whole
from urbanflow.session import materialize

# Kinds of the fixed rules, in the order in which they are listed, then the kinds that the classifier adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "key")
KINDS = (*BASE, *ADDED)

# A match starts where a run starts or where the previous match ended: the same leftmost matches as without that
# condition, but a long run without a match is read once instead of once per character.
_RUN = r"(?:(?<![{0}])|\G)"
PATTERN = {
    "email": _RUN.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": _RUN.format("A-Za-z0-9") + r"[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "key": _RUN.format("A-Za-z0-9_") + r"(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+",
}
# A text without the needle has no match; spares most texts the scan.
NEEDLE = {
    "email": "@", "phone": "+", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "number": PATTERN["number"], "key": r"[A-Za-z0-9_]{16}",
}
AROUND = 24
# Words near personal and near ordinary numbers, beginnings of cards, dialling codes and issued keys.
NEAR_PERSONAL = r"(?i)\b(?:tel|phone|call|mobile|fax|card|account|iban|ssn|passport|id|key|token|secret|password|api)\b[^\n]{0,12}$"
NEAR_ORDINARY = r"(?i)\b(?:page|vol|version|isbn|issn|doi|figure|table|line|year|commit|sha|md5|hash|http|https)\b[^\n]{0,12}$"
KNOWN_NUMBER = r"^(?:4|5[1-5]|34|37|6011|65|1 |44|49|33|34)"
KNOWN_KEY = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|sk_|pk_|xox|glpat|AIza|eyJ)"
# Names made of words: letters, perhaps joined by underscores, and a short number at the end.
NAMED = r"^[A-Za-z]+(?:_[A-Za-z]+)*_?[0-9]{1,4}$"
SHAPED_NUMBER = r"^(?:\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4})$"
SHAPED_KEY = r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|[A-Z]{4}[A-Z0-9]{16}|[a-z]{2,4}_[A-Za-z0-9]{16,})$"
LABELERS = ("shape", "known", "near", "beside", "content")
# Levels of the classifier's features: kind, length, share of digits, character before, character after.
FEATURES = {"kind": 2, "length": 4, "digits": 4, "before": 4, "after": 4}
PATTERNS = 3 ** len(LABELERS) * 2 * 4**4
ROUNDS, PERSONAL = 50, 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: F.expr("0") + F.try_to_number(d, F.lit("9")).cast("int"))
    total = F.aggregate(
        F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(df: DataFrame, kind: str, text: str, out: str) -> DataFrame:
    """Add an array of (start, end, match) of one pattern in code points, end exclusive, invalid matches dropped."""
    needle = F.col(text).contains(NEEDLE[kind]) if len(NEEDLE[kind]) == 1 else F.col(text).rlike(NEEDLE[kind])
    pattern = F.lit(PATTERN[kind])
    df = df.select("*", needle.alias("_has"))
    df = df.select(
        "*", F.when(F.col("_has"), F.regexp_extract_all(text, pattern, F.lit(0))).alias("_found"),
        F.when(F.col("_has"), F.split(text, PATTERN[kind], -1)).alias("_gaps"),
    )
    df = df.select("*", F.transform(F.arrays_zip("_found", "_gaps"), lambda z: F.struct(
        F.coalesce(F.length(z["_gaps"]), F.lit(0)).cast("bigint").alias("g"), F.coalesce(F.length(z["_found"]), F.lit(0)).cast("bigint").alias("f"),
    )).alias("_l"))
    steps = F.when(F.col("_has") & (F.size("_found") > 0), running_sums(F.transform("_l", lambda z: z["g"] + z["f"])))
    df = df.select("*", steps.alias("_at"))
    spans = F.transform("_found", lambda m, i: F.struct(
        (F.get("_at", i) + F.get("_l", i)["g"]).alias("start"), F.get("_at", i + 1).alias("end"), m.alias("match")
    ))
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    good = F.filter(spans, lambda s: _valid(kind, s["match"]))
    return df.select("*", F.coalesce(F.when(F.size("_found") > 0, good), none).alias(out)).drop("_has", "_found", "_gaps", "_l", "_at")


def _vote(yes: Column, no: Column) -> Column:
    """1 for personal, -1 for ordinary, 0 for an abstention; `yes` goes first."""
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _kind_of(char: Column) -> Column:
    """0 blank or nothing, 1 quote or bracket, 2 letter or digit, 3 other."""
    return F.when(char.isNull() | char.isin("", " ", "\n", "\t"), 0).when(char.rlike("[\"'(\\[<)\\]>]"), 1).when(char.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)


def _judged(kind: str, text: str, span: Column) -> Column:
    """(start, end, kind, votes, features) of one candidate."""
    number = kind == "number"
    match, size = span["match"], F.length(span["match"])
    begin = F.greatest(span["start"] - AROUND, F.lit(0))
    before = F.substr(F.col(text), (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
    after = F.substr(F.col(text), (span["end"] + 1).cast("int"), F.lit(1))
    last = F.substr(before, F.greatest(F.length(before), F.lit(1)), F.lit(1))
    digits = _digits(match)
    n = F.length(digits)
    variety = F.size(F.array_distinct(F.split(match, "")))
    votes = [
        _vote(match.rlike(SHAPED_NUMBER if number else SHAPED_KEY), n < 8 if number else F.lower(match) == F.upper(match)),
        _vote(match.rlike(KNOWN_NUMBER if number else KNOWN_KEY), match.rlike("^0" if number else NAMED)),
        _vote(before.rlike(NEAR_PERSONAL), before.rlike(NEAR_ORDINARY)),
        _vote(last.isin('"', "'", "(", "+"), last.isin("$", "#", "%", "/") | after.isin("%", "/")),
        _vote((n.between(13, 19) & luhn(digits)) if number else (variety >= 10), (variety <= 2) if number else (variety <= 6)),
    ]
    share = (4 * n / size).cast("int")
    features = [
        F.lit(int(not number)), F.when(size < 10, 0).when(size < 16, 1).when(size < 24, 2).otherwise(3),
        F.least(share, F.lit(3)), _kind_of(last), _kind_of(after),
    ]
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), F.lit(kind).alias("kind"),
        F.array(*[v.cast("int") for v in votes]).alias("votes"), F.array(*[f.cast("int") for f in features]).alias("features"),
    )


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `_base`: per kind an array of (start, end, match)."""
    df = docs.select("*", whole(text).alias("_t"))
    for kind in BASE:
        df = _matches(df, kind, "_t", f"_{kind}")
    named = F.struct(*[F.col(f"_{k}").alias(k) for k in BASE])
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], "_t", named.alias("_base"))


def candidate_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `_base` and `_more`: candidates with votes and features that no base span overlaps."""
    df = base_spans(docs, text)
    for kind in ADDED:
        df = _matches(df, kind, "_t", f"_{kind}")
    taken = F.concat(*[F.col("_base")[k] for k in BASE])
    df = df.select("*", taken.alias("_taken"))

    def apart(s: Column) -> Column:
        return ~F.exists("_taken", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    free = [F.transform(F.filter(f"_{k}", apart), partial(_judged, k, "_t")) for k in ADDED]
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], "_base", F.concat(*free).alias("_more"))


def aggregate_votes(counts: dict[tuple[int, ...], int]) -> tuple[dict[tuple[int, ...], float], list[dict[int, tuple[float, float]]]]:
    """Posterior of every vote pattern, and per labeler and vote its probability given (ordinary, personal).

    Expectation-maximisation over pattern counts, started from the majority; one pseudo count per vote keeps rare votes
    from certainty, and the majority's direction fixes which class is the personal one.
    """
    posterior = {v: 1 / (1 + exp(-2 * sum(v))) for v in counts}
    rates: list[dict[int, tuple[float, float]]] = []
    for _ in range(ROUNDS):
        mass = sum(counts.values()) + 2
        prior = (sum(c * posterior[v] for v, c in counts.items()) + 1) / mass
        rates = []
        for i in range(len(LABELERS)):
            sums = {vote: [1.0, 1.0] for vote in (-1, 0, 1)}
            for v, c in counts.items():
                sums[v[i]][1] += c * posterior[v]
                sums[v[i]][0] += c * (1 - posterior[v])
            whole_ = [sum(s[k] for s in sums.values()) for k in (0, 1)]
            rates.append({vote: (s[0] / whole_[0], s[1] / whole_[1]) for vote, s in sums.items()})
        for v in counts:
            odds = log(prior / (1 - prior)) + sum(log(r[x][1] / r[x][0]) for r, x in zip(rates, v))
            posterior[v] = 1 / (1 + exp(-max(-700.0, min(700.0, odds))))
    return posterior, rates


def train_classifier(rows: list[tuple[tuple[int, ...], float, int]]) -> list[dict[int, float]]:
    """Weights per feature and level of a logistic model of (features, target, count), by damped gradient steps."""
    weights = [{level: 0.0 for level in range(levels)} for levels in FEATURES.values()]
    mass = sum(c for *_, c in rows) or 1
    for _ in range(400):
        slope = [{level: 1e-3 * w for level, w in part.items()} for part in weights]
        for features, target, count in rows:
            score = sum(w[f] for w, f in zip(weights, features))
            gap = (1 / (1 + exp(-score)) - target) * count / mass
            for part, f in zip(slope, features):
                part[f] += gap
        for part, s in zip(weights, slope):
            for level in part:
                part[level] -= 2.0 * s[level]
    return weights


def fit_weak_labels(candidates: DataFrame) -> list[dict[int, float]]:
    """The classifier's weights from the candidates of all documents; without candidates all weights are zero."""
    spans = candidates.select(F.explode("_more").alias("c"))
    # At most PATTERNS rows, since every vote has three values and every feature a fixed number of levels.
    rows = spans.groupBy("c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")).orderBy("votes", "features").collect()
    counts: dict[tuple[int, ...], int] = {}
    for r in rows:
        counts[tuple(r.votes)] = counts.get(tuple(r.votes), 0) + r.n
    posterior, _ = aggregate_votes(counts)
    return train_classifier([(tuple(r.features), posterior[tuple(r.votes)], r.n) for r in rows])


def _score(features: Column, weights: list[dict[int, float]]) -> Column:
    parts = [F.element_at(F.array(*[F.lit(w[level]) for level in range(len(w))]), features[i] + 1) for i, w in enumerate(weights)]
    return sum(parts[1:], parts[0])


def detected_spans(candidates: DataFrame, weights: list[dict[int, float]]) -> DataFrame:
    """Add `_spans`: (kind, start, end) by kind as listed, then start."""
    bar = log(PERSONAL / (1 - PERSONAL))

    def bare(kind: str, s: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def personal(kind: str, s: Column) -> Column:
        return (s["kind"] == kind) & (_score(s["features"], weights) > bar)

    parts = [F.transform(F.col("_base")[k], partial(bare, k)) for k in BASE]
    parts += [F.transform(F.filter("_more", partial(personal, k)), partial(bare, k)) for k in ADDED]
    return candidates.select("*", F.concat(*parts).alias("_spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row of `docs` (doc_id, text).

    NULL and empty texts have no spans and the hash of the empty string; repeated rows stay; an empty table gives no rows.
    """
    found = materialize(candidate_spans(docs.select("doc_id", "text")).drop("text"))
    detected = detected_spans(found, fit_weak_labels(found))
    counts = [F.size(F.col("_base")[k]).cast("bigint").alias(f"n_{k}") for k in BASE]
    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE))
    return detected.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"),
        F.size(F.filter("_spans", lambda s: ~s["kind"].isin(*BASE))).cast("bigint").alias("n_added"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first start wins."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("e"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint,kind:string>>").alias("out"))
    pieces = F.aggregate(
        ordered, start,
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], -s["e"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
            (-s["e"]).alias("at"),
            F.array_append(a["out"], F.struct(a["at"].alias("a"), s["start"].alias("b"), s["kind"].alias("kind"))).alias("out"),
        )),
    )
    def cut(a: Column, b: Column) -> Column:
        return F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))

    said = F.array_join(F.transform(pieces["out"], lambda p: F.concat(cut(p["a"], p["b"]), F.lit("<"), p["kind"], F.lit(">"))), "")
    return F.when(F.size(spans) > 0, F.concat(said, cut(pieces["at"], F.length(text).cast("bigint")))).otherwise(text)


def mask_personal(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs` with the personal spans of `text` replaced; NULL stays NULL."""
    found = materialize(candidate_spans(as_row(docs, "text")).drop("text"))
    detected = detected_spans(found, fit_weak_labels(found))
    text = masked(F.col("row.text"), F.col("_spans"))
    return detected.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
