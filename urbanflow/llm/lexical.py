"""Ranked lexical search: the documents of the highest impact for each item, by buckets of vector lengths.

A document is its vector of impacts over the terms of the items; an item is the vector of ones over its own terms, and
a score is their product. Vectors are ordered by length. The Cauchy-Schwarz inequality bounds every product by the
lengths, so buckets of vectors too short for an item's tenth best score are passed over; inside a bucket the same bound
is drawn closer by taking the coordinates of the item's heaviest terms as they are and only the rest by length. What
survives is scored again in 64-bit integers, so bounds in floating point decide nothing but work.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.llm.texts import sliced
from urbanflow.session import drop_table, materialize

TOP = 10
# Bytes of item texts whose terms are broadcast at once; more items take further passes over the documents.
CHUNK_BYTES = 8 << 20
# Vectors of a bucket at most, cells of its matrix at most, and coordinates of an item that are taken as they are; only
# speed and memory depend on them.
BUCKET, CELLS, FOCUS = 256, 1 << 24, 4
# The share of the longest vectors that is scored first and gives every other task its thresholds.
HEAD = 0.02
# Bytes of vectors per partition, and what rounding may add to a bound.
PART_BYTES, SLACK = 16 << 20, 1e-9
# A-Z are lowered, and ASCII characters other than letters and digits separate terms.
_FORM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_FORM).split() if text else []


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def item_chunks(items: DataFrame) -> Iterator[list[tuple]]:
    """Lists of (item_id, terms) of about `CHUNK_BYTES` of text each; every row is an item of its own."""
    chunk, size = [], 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text").toLocalIterator():
        chunk.append((row["item_id"], sorted(set(terms_of(row["text"] and bytes(row["text"]))))))
        size += len(row["text"] or b"") + 64
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, ids, tfs) per row of `docs` (doc_id, text): how often which of the terms occur, and all terms' count."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches):
            n, ids, tfs = [], [], []
            for text in _texts(batch["text"]):
                terms = terms_of(text)
                found = np.array([i for i in map(known.get, terms) if i is not None], np.int32)
                found, counts = np.unique(found, return_counts=True)
                n.append(len(terms))
                ids.append(found.tobytes())
                tfs.append(counts.astype(np.int32).tobytes())
            columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "tfs"])

    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"]]).add("n", "long").add("ids", "binary").add("tfs", "binary")
    return rows.mapInArrow(run, schema)


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """How many rows hold each of the `size` terms; a task sends one count per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    sums = np.zeros(size, np.int64)
    for row in vectors.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        sums[row["term"]] = row["n"]
    return sums


def term_weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([floor(1000 * log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequencies], np.int64)


def impacts(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count adds for each unit of weight, in integers."""
    tfs = tfs.astype(np.int64)
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


def impact_vectors(vectors: DataFrame, weights: np.ndarray, documents: int, terms: int) -> DataFrame:
    """(doc_id, length, ids, values) of the rows that hold a weighted term: impacts over those terms, and their length."""
    shared = vectors.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            n = batch["n"].to_numpy(zero_copy_only=False)
            ids, tfs = batch["ids"].to_pylist(), batch["tfs"].to_pylist()
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            at, tf = np.frombuffer(b"".join(ids), np.int32), np.frombuffer(b"".join(tfs), np.int32)
            m = 10 + (90 * n * documents) // max(terms, 1)
            values = w[at] * impacts(tf, np.repeat(m, sizes))
            begins = np.concatenate([[0], np.cumsum(sizes)])
            squares = np.concatenate([[0.0], np.cumsum(values.astype(np.float64) ** 2)])
            parts = [values[a:b] for a, b in zip(begins[:-1], begins[1:])]
            lengths = np.array([float(np.sqrt((p.astype(np.float64) ** 2).sum())) for p in parts]) if squares[-1] else np.zeros(len(parts))
            table = pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(lengths), batch["ids"], pa.array([p.tobytes() for p in parts], pa.binary())],
                ["doc_id", "length", "ids", "values"],
            )
            yield table.filter(pa.array(lengths > 0))

    schema = T.StructType([vectors.schema["doc_id"]]).add("length", "double").add("ids", "binary").add("values", "binary")
    return vectors.mapInArrow(run, schema)


class Best:
    """The highest (score, id) pairs of every item so far and its threshold; NULL ids come after all others."""

    def __init__(self, items: int, top: int, thresholds: np.ndarray) -> None:
        self.top, self.thresholds = top, thresholds.copy()
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        s, i, m = (np.concatenate(x) for x in zip(self.found[item], (scores, ids, missing)))
        order = np.lexsort((i, m, -s))[: self.top]
        self.found[item] = s[order], i[order], m[order]
        if len(order) == self.top:
            self.thresholds[item] = max(self.thresholds[item], s[order[-1]])


def search_slice(batch: pa.RecordBatch, queries: list[np.ndarray], heaviest: list[np.ndarray], place: np.ndarray, best: Best) -> None:
    """Take the vectors of a slice, longest first, bucket by bucket."""
    lengths = batch["length"].to_numpy()
    missing = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
    doc_ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    all_ids, all_values = batch["ids"].to_pylist(), batch["values"].to_pylist()
    order = np.argsort(-lengths, kind="stable")
    sizes = np.array([len(q) for q in queries], np.float64)
    terms_to = np.concatenate([[0], np.cumsum([len(all_ids[r]) // 4 for r in order])])
    end = 0
    while end < len(order):
        cells = (terms_to[end + 1 : end + BUCKET + 1] - terms_to[end]) * np.arange(1, min(BUCKET, len(order) - end) + 1)
        rows = order[end : end + max(1, int(np.searchsorted(cells, CELLS, "right")))]
        end += len(rows)
        alive = np.flatnonzero(np.sqrt(sizes) * lengths[rows[0]] * (1 + SLACK) + 1 >= best.thresholds)
        if not len(alive):
            return  # the vectors that follow are shorter still
        ids = [np.frombuffer(all_ids[r], np.int32) for r in rows]
        flat, column = np.concatenate(ids), np.repeat(np.arange(len(rows)), [len(x) for x in ids])
        terms, at = np.unique(flat, return_inverse=True)
        dense = np.zeros((len(terms) + 1, len(rows)), np.int64)  # the last line stands for terms that none holds
        dense[at, column] = np.concatenate([np.frombuffer(all_values[r], np.int64) for r in rows])
        place[terms] = np.arange(len(terms))
        squares = lengths[rows] ** 2
        for item in alive:
            least = best.thresholds[item]
            focus = dense[place[heaviest[item]]]
            rest = np.sqrt(max(sizes[item] - len(focus), 0) * np.maximum(squares * (1 + SLACK) - (focus.astype(np.float64) ** 2).sum(axis=0), 0))
            near = np.flatnonzero((focus.sum(axis=0) + rest) * (1 + SLACK) + 1 >= least)
            if len(near):
                scores = dense[place[queries[item]]][:, near].sum(axis=0)
                good = (scores > 0) & (scores >= least)
                if good.any():
                    who = rows[near[good]]
                    best.add(item, scores[good], doc_ids[who], missing[who])
        place[terms] = -1


def search(vectors: DataFrame, queries: list[np.ndarray], weights: np.ndarray, thresholds: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score): every task's highest scores of each item, none below the item's threshold."""
    heaviest = [q[np.argsort(-weights[q], kind="stable")[:FOCUS]] for q in queries]
    shared = vectors.sparkSession.sparkContext.broadcast((queries, heaviest, len(weights), thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, first, size, start = shared.value
        best, place = Best(len(asked), top, start), np.full(size, -1, np.int64)
        for batch in batches:
            search_slice(batch, asked, first, place, best)
        for item, (scores, ids, missing) in enumerate(best.found):
            if len(scores):
                columns = [pa.array(np.full(len(scores), item)), pa.array(ids, pa.int64(), mask=missing), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, doc_id long, score long")


def _highest(found: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _searched(docs: DataFrame, chunk: list[tuple], top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one chunk of items, written."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in chunk for t in terms}))}
    queries = [np.array([vocabulary[t] for t in terms], np.int64) for _, terms in chunk]
    vectors = materialize(term_vectors(docs, vocabulary))
    size = F.sum(F.octet_length("ids").cast("long")).alias("bytes")
    told = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms"), size).first()
    documents, terms = told["documents"], told["terms"] or 0
    weights = term_weights(documents, document_frequencies(vectors, len(vocabulary)))
    parts = 3 * (told["bytes"] or 0) // PART_BYTES + 1
    ordered = impact_vectors(vectors, weights, documents, terms).repartitionByRange(parts, F.desc("length"))
    ordered = materialize(ordered.sortWithinPartitions(F.desc("length")))
    drop_table(vectors)

    thresholds = np.ones(len(queries), np.int64)
    cut = ordered.agg(F.percentile_approx("length", F.lit(1 - HEAD), F.lit(1000)).alias("cut")).first()["cut"] or 0.0
    head = materialize(search(ordered.where(F.col("length") >= cut), queries, weights, thresholds, top))
    for row in _highest(head, top).where(F.col("rank") == top).collect():
        thresholds[row["item"]] = max(1, row["score"])
    bounds = [t / np.sqrt(len(q)) for t, q in zip(thresholds, queries) if len(q)]
    shortest = float(min(bounds, default=0)) * (1 - 1e-6) - 1
    rest = ordered.where((F.col("length") < cut) & (F.col("length") >= shortest))
    found = _highest(head.unionByName(search(rest, queries, weights, thresholds, top)), top)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(chunk)], "item long, item_id long")
    return materialize(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest scores above 0 of each row of `items` (item_id, text) among all
    rows of `docs` (doc_id, text).

    A NULL text has no terms. Rows that share an id are documents, or items, of their own. Equal scores are ranked by
    ascending doc_id, NULL last. Empty tables, and items that share no term with a document, give no rows. Columns
    other than those named are not read.
    """
    out = None
    for chunk in item_chunks(items):
        part = _searched(docs.select("doc_id", "text"), chunk, top)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    c AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
    b AS (SELECT i, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM c),
    s AS (SELECT CAST(count(*) FILTER (WHERE len(t) > 0) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
    p AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
    m AS (SELECT r, doc_id, 10 + (90 * CAST(len(t) AS BIGINT) * n_docs) // greatest(n_terms, 1) AS m FROM d, s),
    scored AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM b JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10"""
