"""Benchmark decontamination: which windows of the test items occur in a document, by Wu-Manber search over words.

The patterns are the windows of `WINDOW` consecutive words of every item; an item of fewer words is one pattern of its
own length. Patterns of one length form one search: a table maps every block of words to the distance by which a
position may be skipped, the last block of a window selects the bucket of patterns that end with it, and comparing
whole windows confirms an occurrence. Documents are not shuffled.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.texts import as_row, sliced
from urbanflow.session import drop_table, materialize

WINDOW, BLOCK = 10, 3
# Bytes of item text per search. A benchmark beyond it is searched in as many passes, each written before the next, so
# what is broadcast at once and what a process keeps stay bounded: 2 MB of items of seven-letter words take 100 MB.
CHUNK_BYTES = 2 * 1024 * 1024

# Words are runs of ASCII letters and digits, lower case, and of all bytes of other characters.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def add(table: dict[int, int | list[int]], key: int, value: int) -> None:
    """Most keys have one value, which then needs no list."""
    old = table.get(key)
    if old is None:
        table[key] = value
    elif isinstance(old, list):
        old.append(value)
    else:
        table[key] = [old, value]


def listed(value: int | list[int]) -> list[int]:
    return value if isinstance(value, list) else [value]


class Search:
    """The tables for patterns of one length over numbered words: skips by block, and by last block the places of patterns.

    A block is one integer, and a pattern is the place at which it stands in the words of all items.
    """

    def __init__(self, length: int, base: int, text: array, owners: dict[int, int | list[int]]) -> None:
        self.length, self.base, self.text, self.owners = length, base, text, owners
        self.block = min(BLOCK, length)
        self.skip: dict[int, int] = {}
        self.bucket: dict[int, int | list[int]] = {}
        for place in owners:
            for end in range(self.block, length + 1):
                block = self.key(text, place + end)
                far = length - end
                if self.skip.get(block, length) > far:
                    self.skip[block] = far
            add(self.bucket, block, place)

    def key(self, words: Sequence[int], end: int) -> int:
        """The block that ends before `end` as one integer."""
        key = 0
        for word in words[end - self.block : end]:
            key = key * self.base + word
        return key

    def starts(self, words: array) -> Iterator[tuple[int, list[int]]]:
        """(position, numbers of the items) of every occurrence; words that no item has are -1."""
        length, far = self.length, self.length - self.block + 1
        skip, bucket, end, n = self.skip, self.bucket, self.length, len(words)
        while end <= n:
            if words[end - 1] < 0:
                end += length  # no pattern reaches over this word
                continue
            last = self.key(words, end) if min(words[end - self.block : end]) >= 0 else -1
            step = skip.get(last, far)
            if step == 0:
                here = words[end - length : end]
                for place in listed(bucket[last]):
                    if self.text[place : place + length] == here:
                        yield end - length, listed(self.owners[place])
                        break
                step = 1
            end += step


class Searches:
    """One search per pattern length, and the numbers of the items' words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        text = array("q")
        # Per length: hash of a window -> the first place that has it; windows of equal hash are compared word by word.
        found: dict[int, dict[int, int | list[int]]] = {}
        owners: dict[int, dict[int, int | list[int]]] = {}
        for item, (_, own) in enumerate(items):
            words = array("q", [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(own)])
            size, begin = min(window, len(words)), len(text)
            text += words
            for i in range(len(words) - size + 1 if size else 0):
                here = words[i : i + size]
                known, own_by = found.setdefault(size, {}), owners.setdefault(size, {})
                mark = hash(here.tobytes())
                place = next((p for p in listed(known.get(mark, [])) if text[p : p + size] == here), None)
                if place is None:
                    add(known, mark, begin + i)
                    own_by[begin + i] = item
                elif listed(own_by[place])[-1] != item:
                    add(own_by, place, item)
        found.clear()
        self.all = [Search(size, len(self.numbers) + 1, text, owners[size]) for size in sorted(owners)]

    def words(self, text: str | None) -> array:
        get = self.numbers.get
        return array("q", [get(w, -1) for w in words_of(text)])


def hits_in(text: str | None, searches: Searches) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, occurrences as (first word, end), items) of one text."""
    words = searches.words(text)
    spans, items = [], set()
    for search in searches.all:
        for start, numbers in search.starts(words):
            spans.append((start, start + search.length))
            items.update(numbers)
    return len(words), sorted(spans), {searches.items[n] for n in items}


# The tables of the last chunk that this process searched, by the name of its pass.
_TABLES: dict[tuple, Searches] = {}


def _tables(key: tuple, items, window: int) -> Searches:
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = Searches(items.value, window)
    return _TABLES[key]


def _chunks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The items in lists of at most `CHUNK_BYTES`, one longer item alone; one partition is on the driver at a time."""
    chunk, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").where("text IS NOT NULL").toLocalIterator():
        more = len(row.text.encode())
        if chunk and size + more > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
        chunk.append((row.i or "", row.text))
        size += more
    yield chunk


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add `_n_words`, `_spans` (first word and end of every occurrence) and `_items` (ids with repeats) to `docs`.

    NULL and empty texts have no words. Rows and columns of `docs` stay as they are; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    none = "cast(array() as array<struct<a:int,b:int>>)"
    df = docs.select("*", F.lit(0).cast("bigint").alias("_n_words"), F.expr(none).alias("_spans"), F.expr("cast(array() as array<string>)").alias("_items"))
    items = table = None
    for chunk in _chunks(benchmark):
        if items is not None:  # a pass is written before the next, so that tasks hold one chunk at a time
            df = materialize(df)
            items.destroy()
            if table is not None:
                drop_table(table)
            table = df
        items = spark.sparkContext.broadcast(chunk)
        df = df.mapInArrow(_scan(items, text, window), df.schema)
    return df


def _scan(items, text: str, window: int):
    key = (uuid.uuid4().hex, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _tables(key, items, window)
        for batch in sliced(batches):
            names = batch.schema.names
            counts, spans, ids = [], [], []
            before = zip(batch["_spans"].to_pylist(), batch["_items"].to_pylist())
            for value, (old_spans, old_ids) in zip(batch[text].to_pylist(), before):
                n, found, hit = hits_in(value, searches)
                counts.append(n)
                spans.append(old_spans + [{"a": a, "b": b} for a, b in found])
                ids.append(old_ids + sorted(hit))
            new = {"_n_words": counts, "_spans": spans, "_items": ids}
            columns = [pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of `docs` (doc_id, text).

    NULL and empty texts have no words; repeated rows stay; items that share a window both count; an empty table gives no
    rows, and an empty benchmark hits nothing.
    """
    found = find_items(docs.select("doc_id", "text"), benchmark)
    start = F.struct(F.lit(0).alias("e"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(F.sort_array("_spans"), start, lambda a, s: F.struct(
        F.greatest(a["e"], s["b"]).alias("e"), (a["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(a["e"], s["a"]))).alias("n")
    ))["n"]
    ids = F.sort_array(F.array_distinct("_items"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), covered.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any window of the benchmark, with their columns."""
    return find_items(as_row(docs, "text"), benchmark).where(F.size("_spans") == 0).select("row.*")


_SQL_WORDS = """regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"""
ORACLE = f"""
    WITH d AS (SELECT doc_id, {_SQL_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS.format(t="coalesce(text, '')")} AS w FROM benchmark),
    pieces AS (SELECT DISTINCT item, least(10, len(w)) AS k, unnest([w[i:i + least(10, len(w)) - 1] for i in range(1, len(w) - least(10, len(w)) + 2)]) AS p
               FROM b WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT k FROM pieces),
    places AS (SELECT doc_id, k, generate_subscripts(x, 1) AS pos, unnest(x) AS p
               FROM (SELECT doc_id, k, [w[i:i + k - 1] for i in range(1, len(w) - k + 2)] AS x FROM d, sizes WHERE len(w) >= k)),
    hits AS (SELECT doc_id, pos, k, item FROM places JOIN pieces USING (k, p)),
    covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS word FROM (SELECT DISTINCT doc_id, pos, k FROM hits)) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""
