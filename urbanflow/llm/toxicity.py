"""Toxicity scores from misspelled lexicon terms in their context.

The lexicon is a trie of whole words and of stems that any ending may follow: a few fixed words, and those that labelled
documents show to be abusive. Levenshtein automata run over the trie: a state holds the nodes that the letters read so
far can have reached with how many errors. States and arcs are made when they are first met and kept, so a word costs
one lookup a letter, and most words leave the automaton after a few. Words around a hit tell quotation from abuse: hits
between quotation marks are counted apart, words of reporting weaken a hit and words of address strengthen it. A
logistic model over these sums gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.llm.texts import sliced
from urbanflow.session import drop_table, join_lookup, materialize

# Labelled documents that lexicon and model are fitted on at most, by label; those of the smallest hashes are taken.
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
# Letters of the prefixes that can become stems, and words that a stem must be seen in.
STEM_LETTERS, STEM_WORDS = range(4, 9), 4
# An entry is learned when chance would make one such entry in so many lexicons.
CHANCE = 0.001
# Errors allowed by the length of a whole word; a stem allows none.
ERRORS = ((9, 2), (5, 1), (0, 0))
# Words on each side of a hit that are its context, and characters in which quotation marks are sought.
WINDOW, QUOTE_CHARS = 8, 240
# States that a process keeps; only memory depends on it.
STATES = 200_000
# What is believed of the model before any label, and how many labelled documents' worth: bias, words, stems, quoted hits.
# The belief in the bias is strong, so that one hit can make a document toxic however few toxic ones have only one.
BELIEF, TRUST = np.array([-4.0, 6.0, 4.0, 0.3]), np.array([200.0, 0.5, 0.5, 0.5])
# How much of a whole word's hit a misspelled one is.
MISSPELLED_SHARE = 0.8
SEEDS = """
    abruti abschaum arschloch asqueroso basura clown crétin débile disgusting dummkopf dégoûtant erbärmlich escoria
    estúpido idiot idiota imbecile imbécil imbécile inútil loser minable moron ordure pathetic pathétique patético payaso
    scum stupid trash trottel versager wertlos widerlich worthless
"""
REPORTING = frozenset("said says wrote called quoted quote quotes term word insult sagte schrieb nannte wort zitat dit écrit appelé mot citation dijo escribió llamó palabra cita".split())
ADDRESS = frozenset("you your yourself you're du dich dir dein deine ihr tu toi te ton ta vous votre tú ti tus usted ustedes eres".split())
_WORD = re.compile(r"[^\W_](?:[\w@$*]*[^\W_])?")
_OPEN, _CLOSE = "\"“„«‹'‘", "\"”“»›'’"


def errors_allowed(length: int) -> int:
    return next(errors for least, errors in ERRORS if length >= least)


class Lexicon:
    """The trie: per node its children, the errors that a term below may have, and whether a word or a stem ends there."""

    def __init__(self, words: dict[str, int], stems: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.limit, self.word, self.stem, self.terms = [0], [-1], [-1], {}
        for term, errors in words.items():
            self._add(term, self.word, errors)
        for term in stems:
            self._add(term, self.stem, 0)

    def _add(self, term: str, ends: list[int], errors: int) -> None:
        node = 0
        for letter in term:
            self.limit[node] = max(self.limit[node], errors)
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.limit.append(0)
                self.word.append(-1)
                self.stem.append(-1)
            node = self.children[node][letter]
        self.limit[node] = max(self.limit[node], errors)
        ends[node] = errors
        self.terms[node] = term


# What a word is: no hit, a whole word as it is, a misspelled one, or one that begins with a stem.
NONE, EXACT, MISSPELLED, STEM = range(4)


class Automaton:
    """The Levenshtein automata of all words intersected with a lexicon, made deterministic as words are read."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.members: list[tuple] = []
        self.arcs: list[dict[str, int]] = []
        self.kinds: list[int] = []
        self.stemmed: list[bool] = []
        self.start = self._state({0: 0}, False)

    def _state(self, least: dict[int, int], stemmed: bool) -> int:
        """The number of a state given by nodes with their errors; letters that a text leaves out are errors, too."""
        lexicon = self.lexicon
        waiting = list(least.items())
        for node, errors in waiting:
            if least[node] < errors:
                continue
            for child in lexicon.children[node].values():
                if errors + 1 <= lexicon.limit[child] and errors + 1 < least.get(child, 99):
                    least[child] = errors + 1
                    waiting.append((child, errors + 1))
        stemmed = stemmed or any(errors <= lexicon.stem[node] for node, errors in least.items())
        key = (stemmed, *sorted(least.items()))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.members)
            ends = [errors for node, errors in least.items() if errors <= lexicon.word[node]]
            kind = EXACT if 0 in ends else STEM if stemmed else MISSPELLED if ends else NONE
            self.members.append(tuple(least.items()))
            self.arcs.append({})
            self.kinds.append(kind)
            self.stemmed.append(stemmed)
        return number

    def _arc(self, state: int, letter: str) -> int:
        lexicon, least = self.lexicon, {}

        def reach(node: int, errors: int) -> None:
            if errors <= lexicon.limit[node] and errors < least.get(node, 99):
                least[node] = errors

        for node, errors in self.members[state]:
            for given, child in lexicon.children[node].items():
                reach(child, errors + (given != letter))
            reach(node, errors + 1)
        to = self._state(least, self.stemmed[state]) if least or self.stemmed[state] else -1
        self.arcs[state][letter] = to
        return to

    def _run(self, word: str) -> int:
        if len(self.members) > STATES:
            self._clear()
        state, arcs = self.start, self.arcs
        for letter in word:
            to = arcs[state].get(letter)
            state = self._arc(state, letter) if to is None else to
            if state < 0:
                break
        return state

    def kind(self, word: str) -> int:
        state = self._run(word)
        return NONE if state < 0 else self.kinds[state]

    def meant(self, word: str) -> list[str]:
        """The whole words that a misspelled word can stand for."""
        state = self._run(word)
        return [self.lexicon.terms[n] for n, errors in self.members[state] if 0 < errors <= self.lexicon.word[n]] if state >= 0 else []


class _Kinds(dict):
    """The kinds of words met so far."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) > STATES:
            self.clear()
        kind = self[word] = self.automaton.kind(word)
        return kind


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether a quotation mark opens before and one closes after, in the same line."""
    left = text[max(0, begin - QUOTE_CHARS) : begin].rpartition("\n")[2]
    right = text[end : end + QUOTE_CHARS].partition("\n")[0]
    for opening, closing in zip(_OPEN, _CLOSE):
        if opening == closing:
            inside = left.count(opening) % 2 == 1
        else:
            inside = left.rfind(opening) > left.rfind(closing)
        if opening in "'‘" and inside:  # an apostrophe between letters is none
            at = left.rfind(opening)
            inside = at == 0 or not left[at - 1].isalnum()
        if inside and closing in right:
            return True
    return False


def sums_of(text: str | None, kinds: dict[str, int]) -> list[float]:
    """What the model reads of a text: 1, then logarithms of the weighted hits of words, of stems, and of the quoted ones."""
    words_hit = stems_hit = quotes = 0.0
    if text:
        low = text.lower()
        if len(low) != len(text):
            text = low  # places must agree; a few letters change their length
        words = list(_WORD.finditer(low))
        forms = [m[0] for m in words]
        for i, kind in enumerate(map(kinds.__getitem__, forms)):
            if kind:
                if quoted(text, *words[i].span()):
                    quotes += 1
                    continue
                near = forms[max(0, i - WINDOW) : i + WINDOW + 1]
                weight = (0.5 if not REPORTING.isdisjoint(near) else 1.0) * (1.5 if not ADDRESS.isdisjoint(near) else 1.0)
                if kind == STEM:
                    stems_hit += weight
                else:
                    words_hit += weight * (MISSPELLED_SHARE if kind == MISSPELLED else 1.0)
    # Any prose can have one word that begins like a stem; stems were learned from texts with two or more.
    return [1.0, log1p(words_hit), log1p(max(0.0, stems_hit - 1)), log1p(quotes)]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a label may not be learned from; a NULL id has the checksum of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most `TOXIC_ROWS` and `CLEAN_ROWS` labelled documents that are not held out, written."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialize(known.where(~held_out()))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).unionByName(known.where("toxic <> 1").orderBy(*order).limit(CLEAN_ROWS))
    rows = join_lookup(docs.select("doc_id", "text"), chosen, ["doc_id"], "inner").select("text", (F.col("toxic") == 1).cast("int").alias("toxic"))
    # Copies are no evidence of their own: of documents that share one of three minimum hashes of their words, one stays.
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    least = [F.array_min(F.transform(words, lambda w, k=k: F.xxhash64(w, F.lit(k)))).alias(f"least{k}") for k in range(3)]
    rows = rows.select("*", *least)
    for k in range(3):
        rows = rows.dropDuplicates([f"least{k}"])
    return materialize(rows.select("text", "toxic"))


def entry_counts(rows: DataFrame) -> DataFrame:
    """(stem, entry, toxic, clean, words) over (text, toxic): documents with a word, or with two words or more of a prefix.

    `words` is the number of different words that a prefix begins in toxic documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                words = [w for w in _WORD.findall((text or "").lower()) if not any(c.isdigit() for c in w)]
                prefixes = Counter(w[:k] for w in words for k in STEM_LETTERS if len(w) > k)
                counts[toxic].update((p, "") for p, n in prefixes.items() if n > 1)
                counts[toxic].update({("", w) for w in words} | {(w[:k], w) for w in words if toxic for k in STEM_LETTERS if len(w) > k})
            keys = list(counts[0].keys() | counts[1].keys())
            columns = [[k[0] for k in keys], [k[1] for k in keys], [counts[1][k] for k in keys], [counts[0][k] for k in keys]]
            types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["prefix", "word", "toxic", "clean"])

    parts = rows.mapInArrow(run, "prefix string, word string, toxic long, clean long")
    sums = parts.groupBy("prefix", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # One row per whole word (no prefix) and per prefix: its own counts, and how many words continue it.
    is_pair = (F.col("prefix") != "") & (F.col("word") != "")
    entry = F.when(F.col("prefix") == "", F.col("word")).otherwise(F.col("prefix"))
    counted = sums.groupBy((F.col("prefix") != "").alias("stem"), entry.alias("entry")).agg(
        F.sum(F.when(~is_pair, F.col("toxic")).otherwise(0)).alias("toxic"), F.sum(F.when(~is_pair, F.col("clean")).otherwise(0)).alias("clean"),
        F.count(F.when(is_pair, 1)).alias("words"),
    )
    return counted


def learned_entries(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that toxic documents have far more often than chance; fixed words that labels contradict are left out."""
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    seeds = SEEDS.split()
    if not n.get(1) or not n.get(0):
        return seeds, []
    prior = n[1] / (n[0] + n[1])
    counts = materialize(entry_counts(rows))
    trials = counts.count()
    # The likelihood ratio of a binomial bounds how often chance gives as many toxic documents among those with the entry.
    a, b = F.col("toxic"), F.col("clean")
    share = a / (a + b)
    gain = a * F.log(share / prior) + F.when(b > 0, b * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    strong = counts.where((a > 0) & (share > max(0.5, prior)) & (gain > log(trials / CHANCE)))
    found = strong.collect()
    against = {r["entry"] for r in counts.where(~F.col("stem") & F.col("entry").isin(seeds) & (share < 0.5) & (b >= 5)).collect()}
    drop_table(counts)
    support = {r["entry"]: r["toxic"] for r in found if r["stem"]}
    longer = {e[:-1]: max(support[x] for x in support if x[:-1] == e[:-1]) for e in support}
    # Of prefixes that hold the same documents, the longest; then none that begins with a chosen one.
    closed = sorted((r["entry"] for r in found if r["stem"] and r["words"] >= STEM_WORDS and longer.get(r["entry"], 0) < r["toxic"]), key=len)
    stems: list[str] = []
    for entry in closed:
        if not any(entry.startswith(s) for s in stems):
            stems.append(entry)
    words = sorted({r["entry"] for r in found if not r["stem"] and len(r["entry"]) > 2} | (set(seeds) - against))
    return [w for w in words if not any(w.startswith(s) for s in stems)], stems


def allowances(rows: DataFrame, words: list[str]) -> dict[str, int]:
    """The errors that each word may have: none where words so near to it are common in clean documents of (text, toxic)."""
    allowed = {w: errors_allowed(len(w)) for w in words}
    shared = rows.sparkSession.sparkContext.broadcast(allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, counts = Automaton(Lexicon(shared.value, [])), (Counter(), Counter())
        kinds = _Kinds(automaton)
        for batch in sliced(batches):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                near = {w for w in _WORD.findall((text or "").lower()) if kinds[w] == MISSPELLED}
                counts[toxic].update({term for w in near for term in automaton.meant(w)})
        terms = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]]
        yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

    found = rows.mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    for r in found.where("clean > 1 AND clean > toxic").collect():
        allowed[r["term"]] = 0
    return allowed


def with_sums(rows: DataFrame, words: dict[str, int], stems: list[str], keep: str) -> DataFrame:
    """(`keep`, sums) per row of `rows`, which has the columns `keep` and text."""
    shared = rows.sparkSession.sparkContext.broadcast((words, stems))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _Kinds(Automaton(Lexicon(*shared.value)))
        for batch in sliced(batches):
            sums = [sums_of(text, kinds) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[keep], pa.array(sums, pa.list_(pa.float64()))], [keep, "sums"])

    given = rows.select(keep, "text")
    return given.mapInArrow(run, T.StructType([given.schema[keep]]).add("sums", T.ArrayType(T.DoubleType())))


def fitted(sums: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of the logistic model by Newton's method, drawn towards what is believed without labels.

    A hit never lowers a score: a kind of hits whose weight would be negative has none, and the others are fitted again.
    """
    used = np.ones(len(BELIEF), bool)
    while True:
        w, x, belief, trust = BELIEF[used].copy(), sums[:, used], BELIEF[used], TRUST[used]
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (toxic - p) - trust * (w - belief)
            bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(trust)
            step = np.linalg.solve(bend, slope)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        out = np.zeros(len(BELIEF))
        out[used] = w
        if (out[1:] >= 0).all():
            return out
        used &= np.append(True, out[1:] >= 0)


def learned(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, int], list[str], np.ndarray]:
    """Words with the errors they may have, stems and the model's weights, from labelled documents that are not held out."""
    rows = training_rows(docs, labels)
    words, stems = learned_entries(rows)
    words = allowances(rows, words)
    found = with_sums(rows, words, stems, "toxic").collect()
    sums = np.array([r["sums"] for r in found]).reshape(-1, len(BELIEF))
    weights = fitted(sums, np.array([r["toxic"] for r in found], float))
    drop_table(rows)
    return words, stems, weights


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs` (doc_id, text), learned from `labels` (doc_id, toxic).

    A NULL text is empty and has the score of a text without hits. Repeated rows are scored each. A document is toxic if
    any of its labels says so; labels that are NULL or have a NULL id are not used, and without labels the fixed words
    and the weights believed beforehand give the scores. No documents give no rows.
    """
    words, stems, weights = learned(docs, labels)
    scored = with_sums(docs.select("doc_id", "text"), words, stems, "doc_id")
    total = sum((F.col("sums")[i] * F.lit(float(w)) for i, w in enumerate(weights)), F.lit(0.0))
    score = 1 / (1 + F.exp(-total))
    return scored.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
