"""Near-duplicate groups by min-max hashing.

A document is the set of its word shingles. Under each permutation of the hashes both the smallest and the largest are
kept, so a signature of 2 k values costs k evaluations. Runs of `ROWS` values are the bands; documents that agree in a
band are candidates, and every candidate is confirmed on the full sets. Documents of equal sets are one class from the
start, so copies are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.llm.components import components
from urbanflow.llm.texts import sliced
from urbanflow.session import drop_table, join_lookup, materialize

# Permutations, and values per band: two documents of similarity 0.8 agree in none of the 24 bands with a chance of
# (1 - 0.8 ** 4) ** 24 = 3e-6. The second scheme goes through buckets of more than `WIDE` classes that the first leaves
# unconnected: fewer dissimilar documents agree in 6 values, and 42 bands miss (1 - 0.8 ** 6) ** 42 = 3e-6. Its bands are
# read off 4 bits of each value, so that two rows tell by themselves in which bands they agree.
SCHEMES = ((48, 4), (640, 6))
DIGIT_BANDS = 42
WIDE = 512
# Before sets are compared, 4 bits of each of the second scheme's values are: so many of the first 96 and of all 1,280 may
# differ. At similarity 0.8 on average 18 and 240 do; the bounds are 5.8 and 4.5 standard deviations above.
DIFFER = ((96, 40), (1280, 303))
SHINGLE, SIMILAR = 5, 80
# Words and columns that a task holds at once; only speed depends on them.
REMEMBERED, COLUMNS = 1 << 17, 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of `size` words, A-Z lowered; fewer words are one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = _mixed((total ^ h[k : k + len(total)]) * _MIX + np.uint64(k + 1))
    return np.unique(total)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20140917)
    flips = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    return flips[:, None], (draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def min_max_signature(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """The smallest and the largest hash of a set under each permutation: twice as many values."""
    flips, factors = _permutations(permutations)
    low, high = np.full(permutations, ~np.uint64(0)), np.zeros(permutations, np.uint64)
    for i in range(0, len(shingles), COLUMNS):
        values = (shingles[None, i : i + COLUMNS] ^ flips) * factors
        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
    return _mixed(np.concatenate([low, high]))


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.reshape(-1, rows)
    total = np.zeros(len(bands), np.uint64)
    for k in range(rows):
        total = _mixed((total ^ bands[:, k]) * _MIX + np.uint64(k + 1))
    return total.view(np.int64)


def packed_digits(signature: np.ndarray) -> np.ndarray:
    """Four bits of each value, sixteen values to an integer."""
    digits = (signature & np.uint64(15)).reshape(-1, 16)
    return np.bitwise_or.reduce(digits << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1).view(np.int64)


def sketches(docs: DataFrame, size: int, scheme: tuple[int, int] = SCHEMES[0]) -> DataFrame:
    """(doc_id, n, set_hash, bands, digits) per row of `docs` (doc_id, text); an empty set has only its size, the first
    scheme no digits, and the second no bands but its digits."""
    permutations, per_band = scheme
    digits = scheme == SCHEMES[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in sliced(batches):
            out: list[list] = [[], [], [], []]
            for text in batch["text"].to_pylist():
                s = shingle_set(text, size, hashes)
                row = [len(s), None, None, None]
                if len(s):
                    signature = min_max_signature(s, permutations)
                    values = [None, packed_digits(signature)] if digits else [band_hashes(signature, per_band), None]
                    row = [len(s), xxhash.xxh128_digest(s.tobytes()), *values]
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(v, t) for v, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n", "set_hash", "bands", "digits"])

    rows = docs.select("doc_id", "text")
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([rows.schema["doc_id"]]).add("n", "long").add("set_hash", "binary").add("bands", longs).add("digits", longs)
    return rows.mapInArrow(run, schema)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, items) per row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in sliced(batches):
            sets = [shingle_set(t, size, hashes).view(np.int64) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.list_(pa.int64()))], ["node", "items"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, T.StructType([T.StructField("node", rows.schema["doc_id"].dataType)]).add("items", T.ArrayType(T.LongType())))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, compared whole."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    return both.where(similar(F.col("x"), F.col("y"), percent)).select("a", "b")


def bucket_members(classes: DataFrame) -> DataFrame:
    """(band, value, node, n, first, size) of the classes that share a band's value with another."""
    banded = materialize(classes.select("node", "n", F.posexplode("bands").alias("band", "value")))
    buckets = banded.groupBy("band", "value").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("size"))
    members = materialize(join_lookup(banded, buckets.where("size > 1"), ["band", "value"], "inner"))
    drop_table(banded)
    return members


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): every member of a bucket with its first member and with its hub, where their sizes allow a link.

    The hub shares the most places in buckets with others. The text that a group of copies was made from is closer to
    each copy than these are to each other, so it is their hub, and its star connects them.
    """
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degrees, "node").select("band", "value", F.struct("degree", F.col("node").alias("hub")).alias("r"))
    hubs = ranked.groupBy("band", "value").agg(F.max("r").alias("r")).select("band", "value", "r.hub")
    both = join_lookup(members, hubs, ["band", "value"], "inner").select("node", "n", F.explode(F.array("first", "hub")).alias("b"))
    pairs = both.where("node <> b").select(F.col("node").alias("a"), "n", "b").distinct()
    sizes = members.select(F.col("node").alias("b"), F.col("n").alias("m")).distinct()
    pairs = pairs.join(sizes, "b").where(_similar_size(percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _similar_size(percent: int) -> Column:
    return (100 * F.col("n") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.col("n"))


def _differing(digits: Column, others: Column) -> Column:
    """How many of sixteen four-bit digits differ."""
    x = digits.bitwiseXOR(others)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111)))


def _few_differ() -> Column:
    """Whether few enough digits differ between two rows (digits, others); the first ones rule out most."""
    (some, few), (_, most) = DIFFER
    first = sum((_differing(F.col("digits")[i], F.col("others")[i]) for i in range(1, some // 16)), _differing(F.col("digits")[0], F.col("others")[0]))
    total = F.aggregate(F.zip_with("digits", "others", _differing), F.lit(0), lambda a, x: a + x)
    return (first <= few) & (total <= most)


def mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of the buckets that are not connected."""
    labeled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labeled.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return labeled.join(mixed.select("band", "value"), ["band", "value"], "left_semi")


def similar(x: Column, y: Column, percent: int) -> Column:
    """Whether two sets, compared whole, reach the similarity."""
    shared = F.size(F.array_intersect(x, y))
    return 100 * shared >= percent * (F.size(x) + F.size(y) - shared)


def with_lowest(rows: DataFrame) -> DataFrame:
    """(node, mine) from (node, band, value): all of a node's buckets, so that two nodes tell which is the lowest of both."""
    return rows.groupBy("node").agg(F.collect_list(F.struct("band", "value")).alias("mine"))


def _halves(word: Column) -> tuple[Column, Column]:
    """The digits of two bands."""
    return word.bitwiseAND(F.lit(0xFFFFFF)), F.shiftrightunsigned(word, 32).bitwiseAND(F.lit(0xFFFFFF))


def digit_buckets(digits: Column) -> Column:
    """The buckets of the second scheme: the digits of the 6 values of each band, which begin at every eighth value."""
    halves = F.flatten(F.transform(F.slice(digits, 1, DIGIT_BANDS // 2), lambda w: F.array(*_halves(w))))
    return F.transform(halves, lambda value, band: F.struct(band.alias("band"), value.alias("value")))


def _lowest_digit_band() -> Column:
    """The lowest band whose digits are those of another row (others)."""
    first = F.slice("digits", 1, DIGIT_BANDS // 2), F.slice("others", 1, DIGIT_BANDS // 2)
    differing = F.zip_with(*first, lambda x, y: x.bitwiseXOR(y))
    agree = F.transform(differing, lambda w, i: F.when(_halves(w)[0] == 0, 2 * i).when(_halves(w)[1] == 0, 2 * i + 1))
    return F.array_min(agree)


def unconnected_pairs(nodes: DataFrame, buckets: Column, lowest: Column, percent: int) -> DataFrame:
    """(a, b): nodes (node, n, digits, label, ...) of a bucket that are not connected and not ruled out by sizes or digits.

    A pair is made only in the lowest bucket that both share, which `lowest` tells from the columns of both rows; those of
    the second row are called b, m, others, other and theirs.
    """
    names = {"node": "b", "n": "m", "digits": "others", "label": "other", "mine": "theirs"}
    left = nodes.select("*", F.explode(buckets).alias("bucket")).select(*nodes.columns, "bucket.band", "bucket.value")
    right = left.select(F.col("band").alias("band2"), F.col("value").alias("value2"), *[F.col(c).alias(names[c]) for c in nodes.columns])
    same = (F.col("band") == F.col("band2")) & (F.col("value") == F.col("value2"))
    differ = (F.col("node") < F.col("b")) & (F.col("label") != F.col("other"))
    return left.join(right, same & differ & _similar_size(percent) & _few_differ() & (F.col("band") == lowest)).select(F.col("node").alias("a"), "b")


def near_components(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component) per row of `docs` (doc_id, text): the smallest id reachable over links.

    Rows that share an id are one document. Rows without words are linked with nothing, and a class of rows that all
    have a NULL id has a NULL component. An empty table gives no rows.

    In every bucket of a band, members are first compared with two of them; that connects groups of copies. Then
    members of a bucket that are still unconnected are compared with each other, each pair in one bucket. Buckets that
    are too wide for that are replaced by those of the second scheme over their members. No bucket is cut or left out.
    """
    ids = docs.select("doc_id", "text")
    rows = materialize(sketches(ids, size))
    classes = rows.where("set_hash IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    members = bucket_members(classes)
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    texts = join_lookup(ids.where("doc_id IS NOT NULL"), nodes, ["doc_id"], "left_semi")
    sets = materialize(full_sets(texts, size))
    stars = star_pairs(members, percent)
    edges = materialize(confirmed(stars, sets, percent))
    labels = components(edges)

    mixed = materialize(mixed_buckets(members, labels))
    drop_table(members)
    again = mixed.select(F.col("node").alias("doc_id")).distinct()
    finer = sketches(join_lookup(ids.where("doc_id IS NOT NULL"), again, ["doc_id"], "left_semi"), size, SCHEMES[1])
    finer = materialize(finer.select(F.col("doc_id").alias("node"), "n", "digits").dropDuplicates(["node"]))
    known = finer.join(mixed.select("node", "label").distinct(), "node")
    narrow = known.join(with_lowest(mixed.where(F.col("size") <= WIDE)), "node")
    shared = F.array_min(F.array_intersect("mine", "theirs"))["band"]
    wide = known.join(mixed.where(F.col("size") > WIDE).select("node").distinct(), "node", "left_semi")
    rest = unconnected_pairs(narrow, F.col("mine"), shared, percent)
    rest = rest.unionByName(unconnected_pairs(wide, digit_buckets(F.col("digits")), _lowest_digit_band(), percent)).distinct()
    links = materialize(edges.unionByName(confirmed(rest, sets, percent)))
    for table in (mixed, finer, sets, edges):
        drop_table(table)
    final = components(links, labels)
    drop_table(links)
    drop_table(labels)

    named = rows.where("set_hash IS NOT NULL").groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    named = named.join(final, "node", "left").select("set_hash", F.coalesce("label", "node").alias("component"))
    grouped = rows.where("set_hash IS NOT NULL").select("doc_id", "n", "set_hash").join(named, "set_hash").select("doc_id", "n", "component")
    alone = rows.where("set_hash IS NULL").select("doc_id", "n", F.col("doc_id").alias("component"))
    return grouped.unionByName(alone).withColumnRenamed("n", "n_shingles")


def component_report(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs`; rows without an id are kept."""
    found = near_components(docs, size, percent)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILAR) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its group, and rows without an id, with their columns."""
    gone = near_components(docs, size, percent).where("component <> doc_id").select("doc_id").distinct()
    return join_lookup(docs, gone, ["doc_id"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
