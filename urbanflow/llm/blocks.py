"""Blocks of documents that ask hashed tables for the entries of their keys.

A table over all keys of a corpus (counts of n-grams, owners of passages) grows with it, so no task may hold it. It is
dealt by the hash of the key, and a block of documents, small enough for a task, sends its distinct keys there in
sorted arrays, one row per block and part of the table. The part answers in the same order, so the answers carry no
keys. A key that is everywhere is sent once per block. Blocks are made of the documents' own hashes, so a block that is
computed again after an executor was lost asks for the same keys.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.texts import total_bytes

# Bytes of text per block of documents, and per part of a table.
BLOCK_BYTES, PART_BYTES = 4 << 20, 8 << 20


def in_blocks(docs: DataFrame, text: str = "text", times: int = 1, pack: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, int, int]:
    """`docs` dealt into blocks, `times` as large as usual, with the column `block`, the number of blocks and that of the parts of tables.

    `pack` is what is done to the rows before they are sent.
    """
    size = total_bytes(docs, text)
    blocks, parts = size // (times * BLOCK_BYTES) + 1, size // PART_BYTES + 1
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)))
    return (pack(dealt) if pack else dealt).repartition(blocks, "block"), blocks, parts


def by_part(keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, positions of its keys) for an array of hashes, empty parts left out; positions keep the array's order."""
    part = ((keys >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, begin = np.unique(part[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, begin[1:])))


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds the largest."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()) if len(numbers) else 0)).tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"u{len(data) // count}")).astype(np.int64) if count else np.zeros(0, np.int64)
