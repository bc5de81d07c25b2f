"""Language-model scoring by a weighted backoff automaton.

States are the n-grams seen in training, up to one word shorter than the model's order. An arc reads a word, adds the
logarithm of its smoothed probability and leads to the longest state that ends with it; a state without an arc for the
word is left by its failure arc, which adds the logarithm of the mass kept for unseen words and leads to the state
without its first word. A text's score is the weight of its path.

Probabilities are smoothed with the shorter history as prior: p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K), down to
p(w) = (c(w) + 1) / (N + V + 1), in which one unseen word has the mass of a count of none. Counts come from all training
documents; a block of documents gets the counts of just the n-grams in its own texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.blocks import in_blocks, packed, unpacked
from urbanflow.llm.texts import sliced

ORDER, PRIOR = 3, 64.0
# Blocks are so many times as large as usual: a larger one repeats more of its own n-grams, so it asks for fewer.
TIMES = 3
# Bytes of the step between two keys that are too random to be coded.
_PLAIN = 5
END, BEGIN = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, a begin mark before and the end token after each; and where texts begin."""
    hashes, parts, sizes = _Hashes(), [], []
    for text in texts:
        words = (text or "").encode().lower().split()
        row = np.empty(len(words) + 2, np.uint64)
        row[0], row[-1] = BEGIN, END
        row[1:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        parts.append(row)
        sizes.append(len(row))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values in ascending order, a place of each, and the number of the value at each place."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    numbers = np.empty(len(values), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return ordered[new], order[new], numbers


def zipped(docs: DataFrame) -> DataFrame:
    """The rows with each text packed, its length first; NULL stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            plain = [t if t is None else t.encode() for t in batch["text"].to_pylist()]
            texts = [t if t is None else len(t).to_bytes(8, "little") + pa.compress(t, "zstd", asbytes=True) for t in plain]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.binary()))

    kinds = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join(kinds))


def unzipped(texts: pa.ChunkedArray) -> list[str | None]:
    return [t if t is None else pa.decompress(t[8:], int.from_bytes(t[:8], "little"), "zstd", asbytes=True).decode() for t in texts.to_pylist()]


def by_range(keys: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """(part, places of its keys) for ascending hashes, empty parts left out. A part is a range, so that its keys lie close."""
    part = ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), slice(a, b)) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])]


def coded(keys: np.ndarray) -> bytes:
    """Ascending keys as steps: their low bytes as they are, and the high ones, of which there are few different, packed."""
    steps = np.diff(keys.astype("<u8"), prepend=np.zeros(1, "<u8")).view(np.uint8).reshape(-1, 8)
    high = pa.compress(steps[:, _PLAIN:].T.tobytes(), "zstd", asbytes=True)
    return len(keys).to_bytes(8, "little") + steps[:, :_PLAIN].tobytes() + high


def decoded(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    steps = np.empty((n, 8), np.uint8)
    steps[:, :_PLAIN] = np.frombuffer(data, np.uint8, _PLAIN * n, 8).reshape(n, _PLAIN)
    high = pa.decompress(data[8 + _PLAIN * n :], (8 - _PLAIN) * n, "zstd", asbytes=True)
    steps[:, _PLAIN:] = np.frombuffer(high, np.uint8).reshape(8 - _PLAIN, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def coded_counts(counts: np.ndarray) -> bytes:
    """Counts, most of them small, in the narrowest type and packed."""
    plain = packed(counts)
    return bytes([len(plain) // len(counts)]) + pa.compress(plain, "zstd", asbytes=True)


def decoded_counts(data: bytes, count: int) -> np.ndarray:
    return unpacked(pa.decompress(data[1:], data[0] * count, "zstd", asbytes=True), count)


class Grams:
    """The distinct n-grams of a block per length: their hashes, a place of each, and the one ending at each token.

    Length 0 stands for the begin mark, the only history of a first word. Tokens with too little before them have -1.
    """

    def __init__(self, texts: list[str | None], order: int) -> None:
        tokens, self.begins = token_hashes(texts)
        depth = np.arange(len(tokens)) - np.repeat(self.begins[:-1], np.diff(self.begins))
        self.keys, self.place, self.at = [], [], []
        total = tokens.copy()
        for k in range(order + 1):
            if k == 0:
                here = np.flatnonzero(depth == 0)
            else:
                here = np.flatnonzero((depth >= 1) & (depth >= k - 1))
            if k >= 2:
                longer = np.zeros_like(total)
                longer[1:] = (total[:-1] ^ (tokens[1:] >> np.uint64(7))) * _MIX + tokens[1:]
                total = longer ^ (longer >> np.uint64(31))
            keys, place, inverse = distinct(total[here])
            at = np.full(len(tokens), -1, np.int64)
            at[here] = inverse
            self.keys.append(keys)
            self.place.append(here[place])
            self.at.append(at)


def request(rows: pa.Table, order: int, parts: int) -> pa.Table:
    """(part, block, length, keys, counts) of a block: its n-grams with their counts in its training documents."""
    grams = Grams(unzipped(rows["text"]), order)
    training = np.repeat(~np.array(rows["held_out"].to_pylist(), bool), np.diff(grams.begins))
    out: list[list] = [[], [], [], [], []]
    block = rows["block"][0].as_py()
    for length, keys in enumerate(grams.keys):
        at = grams.at[length]
        counts = np.bincount(at[(at >= 0) & training], minlength=len(keys))
        for part, places in by_range(keys, parts):
            for column, value in zip(out, (part, block, length, coded(keys[places]), coded_counts(counts[places]))):
                column.append(value)
    return pa.table([pa.array(v, t) for v, t in zip(out, _REQUEST.values())], list(_REQUEST))


_REQUEST = {"part": pa.int64(), "block": pa.int64(), "length": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}
_ANSWER = {"part": pa.int64(), "block": pa.int64(), "length": pa.int32(), "totals": pa.binary(), "tokens": pa.int64(), "types": pa.int64()}


def answer(rows: pa.Table) -> pa.Table:
    """(part, block, length, totals, tokens, types) of a part: sums over all blocks in the order that each asked for.

    `tokens` and `types` are the part's training words and distinct ones; only its first answer carries them.
    """
    lengths, keys = np.array(rows["length"].to_pylist()), rows["keys"].to_pylist()
    counts, totals, tokens, types = rows["counts"].to_pylist(), [b""] * rows.num_rows, 0, 0
    for length in np.unique(lengths):
        asked = np.flatnonzero(lengths == length)
        arrays = [decoded(keys[i]) for i in asked]
        known, _, inverse = distinct(np.concatenate(arrays))
        own = np.concatenate([decoded_counts(counts[i], len(a)) for i, a in zip(asked, arrays)])
        sums = np.bincount(inverse, own, len(known)).astype(np.int64)
        if length == 1:
            tokens, types = int(sums.sum()), int((sums > 0).sum())
        for i, part in zip(asked, np.split(sums[inverse], np.cumsum([len(a) for a in arrays])[:-1])):
            totals[i] = coded_counts(part)
    n = rows.num_rows
    columns = [rows["part"], rows["block"], rows["length"], totals, [tokens] + [0] * (n - 1), [types] + [0] * (n - 1)]
    return pa.table([pa.array(c.to_pylist() if isinstance(c, pa.ChunkedArray) else c, t) for c, t in zip(columns, _ANSWER.values())], list(_ANSWER))


class Automaton:
    """States, arcs and failure arcs among the n-grams of a block."""

    def __init__(self, grams: Grams, totals: list[np.ndarray], tokens: int, types: int, prior: float) -> None:
        self.order = len(totals) - 1
        p = (totals[1] + 1) / (tokens + types + 1)
        self.arc = [None, np.log10(p)]
        self.seen = [None, totals[1] > 0]
        self.fail: list = [np.log10(prior / (totals[0] + prior))]
        for length in range(2, self.order + 1):
            here = grams.place[length]
            before = grams.at[length - 1][here - 1]
            history = totals[length - 1][before]
            if length == 2:
                history = np.where(before < 0, totals[0][0] if len(totals[0]) else 0, history)
            p = (totals[length] + prior * p[grams.at[length - 1][here]]) / (history + prior)
            self.arc.append(np.log10(p))
            self.seen.append(totals[length] > 0)
        self.fail += [np.log10(prior / (t + prior)) for t in totals[1 : self.order]]

    def scores(self, at: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
        """The weight of each document's path; `at[k]` has the n-gram of length k that ends at each token.

        The state after a token is the longest n-gram seen that ends with it: all that it is made of was seen where it was,
        so the state before had the arc. That gives all states first; then failure arcs are followed a length at a time.
        """
        order, tokens = self.order, int(begins[-1])
        starts = begins[:-1]
        read = np.zeros(tokens, np.int64)
        for k in range(1, order + 1):
            there = np.flatnonzero(at[k] >= 0)
            read[there[self.seen[k][at[k][there]]]] = k
        # The length of the state before each token; the begin mark is a history of one word, as any single word is.
        state = np.minimum(read, order - 1)
        state[starts] = 1
        state = np.concatenate([[0], state[:-1]])
        state[starts] = 0
        read = np.maximum(read, 1)
        read[starts] = 0
        weights = np.zeros((tokens, order))  # of failure arcs, the longest history first, and of the arc
        for length in range(order - 1, 0, -1):
            fallen = np.flatnonzero((state >= length) & (read <= length) & (read > 0))
            history = at[length][fallen - 1]
            marks = history < 0
            weights[fallen[~marks], order - 1 - length] = self.fail[length][history[~marks]]
            weights[fallen[marks], order - 1 - length] = self.fail[0][0] if marks.any() else 0.0
        for k in range(1, order + 1):
            there = np.flatnonzero(read == k)
            weights[there, order - 1] = self.arc[k][at[k][there]]
        document = np.repeat(np.arange(len(starts)), np.diff(begins) * order)
        return np.bincount(document, weights.ravel(), len(starts))


def score_block(rows: pa.Table, answers: pa.Table, order: int, parts: int, prior: float) -> pa.Table:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of a block's documents."""
    grams = Grams(unzipped(rows["text"]), order)
    totals = [np.zeros(len(k), np.int64) for k in grams.keys]
    given = {(r["length"], r["part"]): r["totals"] for r in answers.select(["length", "part", "totals"]).to_pylist()}
    for length, keys in enumerate(grams.keys):
        for part, places in by_range(keys, parts):
            totals[length][places] = decoded_counts(given[length, part], places.stop - places.start)
    tokens, types = answers["all_tokens"][0].as_py(), answers["all_types"][0].as_py()
    automaton = Automaton(grams, totals, tokens, types, prior)
    count = np.where(grams.at[1] >= 0, totals[1][grams.at[1]], -1)
    base = np.where(count >= 0, np.log10((np.maximum(count, 0) + 1) / (tokens + types + 1)), 0.0)
    out: list[list] = [[], [], [], automaton.scores(grams.at, grams.begins)]
    for a, b in zip(grams.begins[:-1], grams.begins[1:]):
        out[0].append(b - a - 1)
        out[1].append(int((count[a:b] > 0).sum()))
        out[2].append(float(base[a:b].sum()))
    columns = [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
    all_tokens = pa.array([tokens] * rows.num_rows, pa.int64())
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return pa.table([rows["doc_id"], rows["held_out"], columns[0], columns[1], all_tokens, columns[2], columns[3]], names)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training; a NULL id has the checksum of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def scores(docs: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (doc_id, text).

    NULL counts as empty, of which the end token is scored. Repeated rows train and are scored once each. An empty table
    gives no rows. Words and n-grams are told apart by 64-bit hashes.
    """
    if order < 2:
        raise ValueError("a backoff model has at least two words")
    rows, _, parts = in_blocks(docs.select("doc_id", "text", held_out().alias("held_out")), times=TIMES, pack=zipped)
    asked = rows.groupBy("block").applyInArrow(
        lambda t: request(t, order, parts), "part long, block long, length int, keys binary, counts binary"
    )
    answers = asked.groupBy("part").applyInArrow(
        answer, "part long, block long, length int, totals binary, tokens long, types long"
    )
    told = answers.select(
        "part", "block", "length", "totals", answers.agg(F.sum("tokens")).scalar().alias("all_tokens"),
        answers.agg(F.sum("types")).scalar().alias("all_types"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        lambda left, right: score_block(left, right, order, parts, prior),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
