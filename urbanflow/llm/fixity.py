"""WARC fixity audit: hash trees over the records of an archive, compared between replicas from the root down.

A record is a page written as a WARC record. Records are ordered by page id; `SHARD` consecutive ids are one archive
file, in which a record's offset is the sum of the lengths before it. A leaf is the hash of a record with its offset;
a node is the hash of its children in order and covers their offset range. Trees of replicas are compared level by
level, and only the children of differing nodes are read further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflow.session import drop_table, materialize

# Ids per archive file, and children of a node: bounds of every group that is ever formed. The records of one id are
# dealt by the first characters of their hashes, so an id of very many records is none.
SHARD, FANOUT, DEALT = 1024, 32, 3


def warc_record(url: Column, html: Column) -> Column:
    """The bytes of a response record; NULL fields are empty. The record's identity is the hash of its payload."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.sha2(body, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def archive(pages: DataFrame) -> DataFrame:
    """(page_id, record) of `pages` (page_id, url, html)."""
    return pages.select("page_id", warc_record(F.col("url"), F.col("html")).alias("record"))


def leaves(records: DataFrame) -> DataFrame:
    """(page_id, copy, start, length, sha256) of (page_id, record): the last two of the record, its offset in its file.

    A NULL id counts as -1. Rows that repeat an id are numbered in the order of their hashes and lengths; equal ones are
    counted before they are numbered. Offsets are sums inside a part of an id's records, plus the parts and ids before.
    """
    hashed = records.select(
        F.coalesce(F.col("page_id").cast("bigint"), F.lit(-1).cast("bigint")).alias("page_id"),
        F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("sha256"),
    )
    counted = hashed.groupBy("page_id", "sha256", "length").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("part", F.substring("sha256", 1, DEALT))
    inside = Window.partitionBy("page_id", "part").orderBy("sha256", "length").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select("*", F.sum("n").over(inside).alias("n_here"), F.sum(F.col("n") * F.col("length")).over(inside).alias("bytes_here"))
    parts = counted.groupBy("page_id", "part").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("length")).alias("bytes"))
    of_id = Window.partitionBy(F.expr(f"page_id div {SHARD}"), "page_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy(F.expr(f"page_id div {SHARD}")).orderBy("page_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("page_id", "part", F.sum("rows").over(of_id).alias("n_before"), F.sum("bytes").over(of_file).alias("bytes_before"))
    joined = placed.join(before, ["page_id", "part"])
    zero = F.lit(0).cast("bigint")
    number = F.coalesce("n_before", zero) + F.coalesce("n_here", zero) + F.col("k") + 1
    start = F.coalesce("bytes_before", zero) + F.coalesce("bytes_here", zero) + F.col("k") * F.col("length")
    spread = joined.select("*", F.explode(F.sequence(zero, F.col("n") - 1)).alias("k"))
    return spread.select("page_id", number.alias("copy"), start.alias("start"), "length", "sha256")


def _node(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, end, hash) over children (keys, at, start, end, hash); a single child stands for itself."""
    children = F.sort_array(F.collect_list(F.struct("at", "hash")))
    joined = F.array_join(F.transform(children, lambda c: F.concat_ws("=", c["at"].cast("string"), c["hash"])), ",")
    value = F.when(F.count(F.lit(1)) == 1, F.first("hash")).otherwise(F.sha2(joined, 256))
    return rows.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"), value.alias("hash"))


def _per_id(leaf_rows: DataFrame) -> DataFrame:
    """(page_id, start, end, hash): the leaf of an id, or the root of a tree over its copies."""
    leaf = F.sha2(F.concat_ws("|", "sha256", F.col("start").cast("string"), F.col("length").cast("string")), 256)
    rows = leaf_rows.select("page_id", F.col("copy").alias("at"), "start", (F.col("start") + F.col("length")).alias("end"), leaf.alias("hash"))
    copies = leaf_rows.agg(F.max("copy")).first()[0] or 0
    while copies > 1:
        group = F.expr(f"cast((at - 1) div {FANOUT} + 1 as bigint)")
        rows = _node(rows.withColumn("up", group), ["page_id", "up"]).withColumnRenamed("up", "at")
        copies = (copies - 1) // FANOUT + 1
    return rows.drop("at")


def hash_tree(leaf_rows: DataFrame) -> list[DataFrame]:
    """Levels of the tree as written tables (node, start, end, hash), ids' parents first, the root last.

    A node of level k covers `FANOUT`^k consecutive ids; division cuts towards zero, so that negative ids end at the
    same root. The copies of an id have a tree of their own below it. No leaves give one empty level.
    """
    levels, width = [], 1
    below = _per_id(leaf_rows).select(F.col("page_id").alias("at"), F.expr(f"page_id div {FANOUT}").alias("node"), "start", "end", "hash")
    while True:
        children = F.sort_array(F.collect_list(F.struct("at", "hash")))
        joined = F.array_join(F.transform(children, lambda c: F.concat_ws("=", c["at"].cast("string"), c["hash"])), ",")
        level = materialize(below.groupBy("node").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sha2(joined, 256).alias("hash")))
        levels.append(level)
        width = level.count()
        if width <= 1:
            return levels
        below = level.select(F.col("node").alias("at"), F.expr(f"node div {FANOUT}").alias("node"), "start", "end", "hash")


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs, or that only one side has."""
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_value"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    joined = a.select(*keys, value).join(right, same, "full_outer").where(~F.col(value).eqNullSafe(F.col("_value")))
    return joined.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys])


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(page_id, copy, file, start, length, expected, actual, kind) of the records that differ between two replicas.

    `first` and `second` are (page_id, record). Kinds: changed, missing (only in the first), extra (only in the
    second). A record that merely moved, because one before it in its file changed its length, is not reported. Equal
    replicas, and two empty ones, give no rows.
    """
    sides = [materialize(leaves(r)) for r in (first, second)]
    trees = [hash_tree(s) for s in sides]
    while len(trees[0]) != len(trees[1]):
        shorter = min(trees, key=len)
        root = shorter[-1].select(F.expr(f"node div {FANOUT}").alias("node"), "start", "end", F.sha2(F.concat(F.lit("up"), "hash"), 256).alias("hash"))
        shorter.append(materialize(root))
    suspects = None
    for a, b in zip(reversed(trees[0]), reversed(trees[1])):
        if suspects is not None:
            parent = F.expr(f"node div {FANOUT}").alias("node")
            a, b = (t.withColumn("up", parent).join(suspects.withColumnRenamed("node", "up"), "up", "left_semi") for t in (a, b))
        found = materialize(_differing(a, b, ["node"], "hash"))
        if suspects is not None:
            drop_table(suspects)
        suspects = found
    keep = ["page_id", "copy", "start", "length", "sha256"]
    a, b = (
        s.withColumn("node", F.expr(f"page_id div {FANOUT}")).join(suspects, "node", "left_semi").select(*keep) for s in sides
    )
    right = b.select(*[F.col(c).alias(f"_{c}") for c in keep])
    joined = a.join(right, (F.col("page_id") == F.col("_page_id")) & (F.col("copy") == F.col("_copy")), "full_outer")
    kind = F.when(F.col("_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra").otherwise("changed")
    either = {c: F.coalesce(c, f"_{c}") for c in ("page_id", "copy", "start", "length")}
    return joined.where(~F.col("sha256").eqNullSafe(F.col("_sha256"))).select(
        either["page_id"].alias("page_id"), either["copy"].alias("copy"), F.floor(either["page_id"] / SHARD).alias("file"),
        either["start"].alias("start"), either["length"].alias("length"),
        F.col("sha256").alias("expected"), F.col("_sha256").alias("actual"), kind.alias("kind"),
    )
