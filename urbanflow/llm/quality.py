"""Quality rules: counted statistics, fixed base rules, and robust multivariate outliers per language and source.

The verdict of the method is the Mahalanobis distance of a document's transformed statistics from a
minimum-covariance-determinant estimate: the mean and the scatter of the densest share of a group's documents, found
by concentration steps from two deterministic starts. Everything is DataFrame expressions; a group is only ever
reduced to sums, so one group may hold any share of the rows.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.texts import as_row, whole, words_of
from urbanflow.session import drop_table, join_lookup, materialize

WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Pseudo words, of an assumed length, that every document is given: the rates of short texts are noise.
PRIOR_WORDS, PRIOR_LENGTH = 50, 5.5
# Smallest standard deviation of each transformed statistic: a group in which a statistic never varies must not
# reject the first document that differs a little.
FLOORS = (0.08, 0.06, 0.06, 0.09)
DIMENSIONS = len(FLOORS)
# Share of a group that the estimate rests on, share kept when it is reweighted, share of a clean group kept.
DENSEST, REWEIGHTED, CLEAN = 0.75, 0.975, 0.9999
# As many documents' worth of its language's estimate goes into that of a group, and of all documents' into a language's.
BORROWED = 40
# Concentration ends when no step lowers the logarithm of a group's determinant by as much as this.
SETTLED = 1e-3
_X = [f"x{i}" for i in range(DIMENSIONS)]
_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
_PARAMETERS = [*[f"m{i}" for i in range(DIMENSIONS)], *[f"l{i}{j}" for i, j in _PAIRS]]


def text_statistics(docs: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """Add the struct `out` with the five counts of `COUNTS`; NULL and empty texts count zero.

    Repeated windows are found by the 64-bit hashes of their words, within one text.
    """
    df = docs.select("*", whole(text).alias("_t"))
    df = df.select("*", words_of(F.col("_t")).alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_l"))
    df = df.select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(0), F.size("_h") - WINDOW)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))
    df = df.select("*", F.when(F.size("_h") >= WINDOW, hashed).otherwise(none).alias("_v"))
    ordered = F.sort_array(F.transform("_v", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    repeated = F.size(F.array_distinct("_v")) < F.size("_v")
    df = df.select("*", F.when(repeated, ordered).alias("_s"))
    twice = F.filter("_s", lambda e, i: (F.get("_s", i - 1)["v"] == e["v"]) | (F.get("_s", i + 1)["v"] == e["v"]))
    df = df.select("*", F.sort_array(F.transform(twice, lambda e: e["i"])).alias("_p"))
    covered = F.aggregate(
        "_p", F.struct(F.lit(0).alias("e"), F.lit(0).cast("bigint").alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("e"), (a["n"] + F.least(F.lit(WINDOW), p + WINDOW - a["e"])).alias("n")),
    )["n"]
    length = F.length("_t")
    counts = [
        F.size("_w").cast("bigint"),
        F.length(F.translate("_t", " \t\n\x0b\f\r", "")).cast("bigint"),
        (length - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("bigint"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
        F.coalesce(covered, F.lit(0).cast("bigint")),
    ]
    stats = F.struct(*[c.alias(n) for c, n in zip(counts, COUNTS)])
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], stats.alias(out))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def transformed(stats: Column) -> list[Column]:
    """Log mean word length, and square roots of the rates of symbols, repeated lines and repeated words."""
    n, chars = stats["n_words"] + F.lit(float(PRIOR_WORDS)), stats["word_chars"] + F.lit(PRIOR_WORDS * PRIOR_LENGTH)
    return [F.log(chars / n), F.sqrt(stats["n_symbols"] / chars), F.sqrt(stats["n_dup_lines"] / n), F.sqrt(stats["n_repeat_words"] / n)]


def _chi2(x: float, df: int) -> float:
    """The chi-square distribution function for an even number of degrees."""
    term = total = 1.0
    for k in range(1, df // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def chi2_quantile(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, df) < p else (low, mid)
    return low


def _consistency(share: float) -> float:
    """What the scatter of the densest `share` of normal data is multiplied with to be that of all of it."""
    return share / _chi2(chi2_quantile(share, DIMENSIONS), DIMENSIONS + 2)


def _cholesky(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, m*, l*, logdet) from (keys, n, m*, c*): the lower triangle of the scatter's root, floors added."""
    for i, j in _PAIRS:
        inner = F.col(f"c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0)
        for k in range(j):
            inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # Rounding can take a pivot of nearly collinear statistics below its floor, never by design.
        root = F.sqrt(F.greatest(inner, F.lit(1e-12))) if i == j else inner / F.col(f"l{j}{j}")
        df = df.select("*", root.alias(f"l{i}{j}"))
    logdet = sum((F.log(f"l{i}{i}") for i in range(1, DIMENSIONS)), F.log("l00"))
    return df.select(*keys, "n", *[f"m{i}" for i in range(DIMENSIONS)], *[f"l{i}{j}" for i, j in _PAIRS], logdet.alias("logdet"))


def _distance(df: DataFrame, name: str) -> DataFrame:
    """Squared Mahalanobis distance of (x*) under (m*, l*), by forward substitution."""
    for i in range(DIMENSIONS):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"_z{k}")
        df = df.select("*", (rest / F.col(f"l{i}{i}")).alias(f"_z{i}"))
    z = [F.col(f"_z{i}") for i in range(DIMENSIONS)]
    return df.select("*", sum((c * c for c in z[1:]), z[0] * z[0]).alias(name)).drop(*[f"_z{i}" for i in range(DIMENSIONS)])


def _moments(df: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Means and scatter times `factor` of the rows of each key, with partial sums before the shuffle."""
    sums = [F.avg(f"x{i}").alias(f"m{i}") for i in range(DIMENSIONS)]
    products = [(F.covar_pop(f"x{i}", f"x{j}") * factor).alias(f"c{i}{j}") for i, j in _PAIRS]
    return _cholesky(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *products), keys)


def _starts(rows: DataFrame) -> DataFrame:
    """Start 0: medians and median deviations. Start 1: medians and the floors alone."""
    middle = materialize(rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f"x{i}", 0.5, 10000).alias(f"m{i}") for i in range(DIMENSIONS)]
    ))
    apart = join_lookup(rows, middle, ["g"], "inner").groupBy("g").agg(
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10000).alias(f"d{i}") for i in range(DIMENSIONS)]
    )
    both = middle.join(apart, "g").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    spread = [
        (F.when(F.col("start") == 0, F.pow(1.4826 * F.col(f"d{i}"), 2)).otherwise(0.0) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i, j in _PAIRS
    ]
    return _cholesky(both.select("*", *spread), ["g", "start"])


def concentrated(rows: DataFrame) -> DataFrame:
    """(g, start, n, m*, l*, logdet) for written rows (g, x*): the densest share of each group, from each start.

    A step keeps the rows nearest to the last estimate, which never raises the determinant; steps go on until no
    group's falls any more. Cut-offs come from mergeable quantile sketches.
    """
    estimate = materialize(_starts(rows))
    last = None
    while True:
        far = _distance(join_lookup(rows, estimate, ["g"], "inner"), "d")
        cuts = far.groupBy("g", "start").agg(F.percentile_approx("d", DENSEST, 10000).alias("cut"))
        near = join_lookup(far, cuts, ["g", "start"], "inner").where("d <= cut")
        better = materialize(_moments(near, ["g", "start"], _consistency(DENSEST)))
        old = estimate.select("g", "start", F.col("logdet").alias("before"))
        fall, level = better.join(old, ["g", "start"]).agg(F.max(F.col("before") - F.col("logdet")), F.sum("logdet")).first()
        drop_table(estimate)
        estimate = better
        # The first step leaves the starts, which are no subsets; from then on determinants fall, but for the sketches.
        if level is None or (last is not None and (fall < SETTLED or level >= last)):
            return estimate
        last = level


def densest_estimates(rows: DataFrame) -> DataFrame:
    """(g, n, m*, l*) for rows (g, x*): the reweighted minimum-covariance-determinant estimate of every group.

    The best of the starts is the one of the smallest determinant; `n` counts the group.
    """
    rows = materialize(rows)
    estimate = concentrated(rows)
    best = estimate.groupBy("g").agg(F.min(F.struct("logdet", "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    chosen = estimate.join(best, ["g", "start"]).drop("start", "logdet", "n")
    near = _distance(join_lookup(rows, chosen, ["g"], "inner"), "d").where(F.col("d") <= chi2_quantile(REWEIGHTED, DIMENSIONS))
    final = _moments(near.drop(*[c for c in chosen.columns if c != "g"]), ["g"], _consistency(REWEIGHTED))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    out = materialize(final.drop("logdet", "n").join(sizes, "g"))
    drop_table(estimate)
    drop_table(rows)
    return out


def shrunk(estimates: DataFrame, parents: DataFrame) -> DataFrame:
    """(g, n, m*, l*) of (g, parent, n, m*, l*) drawn towards their parents' (g, m*, l*), smoothly by their sizes."""
    own = F.col("n") / (F.col("n") + F.lit(float(BORROWED)))
    named = parents.select(F.col("g").alias("parent"), *[F.col(c).alias(f"p{c}") for c in _PARAMETERS])

    def scatter(i: int, j: int, p: str = "") -> Column:
        return sum((F.col(f"{p}l{i}{k}") * F.col(f"{p}l{j}{k}") for k in range(1, j + 1)), F.col(f"{p}l{i}0") * F.col(f"{p}l{j}0"))

    means = [(own * F.col(f"m{i}") + (1 - own) * F.col(f"pm{i}")).alias(f"m{i}") for i in range(DIMENSIONS)]
    # The floors are in both scatters and are added again.
    mixed = [(own * scatter(i, j) + (1 - own) * scatter(i, j, "p") - (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in _PAIRS]
    return _cholesky(estimates.join(named, "parent").select("g", "n", *means, *mixed), ["g"]).drop("logdet")


def _group(*names: str) -> Column:
    """A key of the named columns in which NULL is a value of its own; all documents without names."""
    return F.concat_ws("\x1f", F.lit(str(len(names))), *[F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("-")) for n in names])


def quality_verdicts(counted: DataFrame, stats: str = "stats", lang: str = "lang", source: str = "source") -> DataFrame:
    """Add `_failed`, `_distance` (NULL for failed rows) and `_kept` to a written table that has the counts.

    Rows that fail the base rules neither shape the estimates nor get a distance. Every group has an estimate, since
    the floors make any scatter invertible; it is drawn towards that of its language, and a language's towards that of
    all documents, the more the smaller it is (`BORROWED`). No group yields no rows to judge.
    """
    failed = F.coalesce(base_failed(F.col(stats)), F.lit(True))
    x = [c.alias(n) for c, n in zip(transformed(F.col(stats)), _X)]
    keys = F.array(_group(lang, source), _group(lang), _group())
    passing = counted.where(~failed)
    families = materialize(passing.select(_group(lang, source).alias("g"), _group(lang).alias("parent")).distinct())
    estimates = densest_estimates(passing.select(F.explode(keys).alias("g"), *x))
    languages = estimates.join(families.select(F.col("parent").alias("g")).distinct(), "g").withColumn("parent", F.lit("0"))
    languages = materialize(shrunk(languages, estimates.where("g = '0'")))
    groups = materialize(shrunk(estimates.join(families, "g"), languages))
    parameters = groups.drop("n").withColumnRenamed("g", "_g")
    judged = counted.select("*", F.when(~failed, _group(lang, source)).alias("_g"), failed.alias("_failed"), *x)
    judged = _distance(join_lookup(judged, parameters, ["_g"]), "_distance")
    kept = ~F.col("_failed") & F.coalesce(F.col("_distance") <= chi2_quantile(CLEAN, DIMENSIONS), F.lit(True))
    return judged.select(*[F.col(f"`{c}`") for c in counted.columns], "_failed", "_distance", kept.alias("_kept"))


def quality_report(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, distance) of every row of `docs` (doc_id, text, lang, source).

    Repeated rows stay and get equal verdicts; NULL and empty texts fail the base rules; an empty table gives no rows.
    """
    counted = materialize(text_statistics(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    judged = quality_verdicts(counted)
    return judged.select(
        "doc_id", *[F.col(f"stats.{c}").alias(c) for c in COUNTS], F.col("_failed").alias("base_failed"),
        F.col("_kept").alias("kept"), F.col("_distance").alias("distance"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, with the columns of `docs` unchanged."""
    counted = materialize(text_statistics(as_row(docs, "text", "lang", "source")).drop("text"))
    return quality_verdicts(counted).where("_kept").select("row.*")
