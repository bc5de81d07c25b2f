"""Byte-level BPE by tree reduction: halves are encoded, then joined by re-encoding a window around the seam.

Why a window is enough: a token sequence is the encoding of its bytes exactly when every two neighbours are the
encoding of theirs. A window that is re-encoded keeps its first token from the left half and its last token from the
right half once it is wide enough; then every pair outside, and the pairs at its rims, are the pairs they were. A side
whose rim changed is widened until it holds or the whole half is inside. Decoding joins the bytes of halves.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of up to this many bytes are merged directly; windows start with this many tokens on either side.
LEAF, RIM = 16, 2
# Distinct pieces that a task remembers; only speed depends on it.
REMEMBERED = 200_000
# Rows whose tokens and bytes are in memory at once.
ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_short(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """`merge_bytes` for a few bytes, where scanning all pairs is cheaper than a heap."""
    cuts, none = list(range(len(part) + 1)), 1 << 62
    look = ranks.get
    near = [look(part[i : i + 2], none) for i in range(len(part) - 1)]
    while near:
        best = min(near)
        if best == none:
            break
        i = near.index(best)
        del cuts[i + 1], near[i]
        if i < len(near):
            near[i] = look(part[cuts[i] : cuts[i + 2]], none)
        if i:
            near[i - 1] = look(part[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[part[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_bytes(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of lowest rank, leftmost first, until none can be merged."""
    n = len(part)
    if n <= 4 * LEAF:
        return merge_short(part, ranks)
    end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends
    before = list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(part[i : i + 2])) is not None]
    heapify(heap)
    alive = bytearray(b"\x01" * n)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        end[i], alive[j] = stop, 0
        before[stop] = i
        if stop < n:
            r = ranks.get(part[i : end[stop]])
            if r is not None:
                heappush(heap, (r, i, end[stop]))
        k = before[i]
        if k >= 0:
            r = ranks.get(part[k:stop])
            if r is not None:
                heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[part[i : end[i]]])
        i = end[i]
    return out


class TreeBpe:
    """Encodes and decodes with the ranks of a vocabulary whose ids are its ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def encode_part(self, part: bytes) -> list[int]:
        if len(part) <= LEAF:
            return merge_bytes(part, self.ranks)
        middle = len(part) // 2
        return self.join(self.encode_part(part[:middle]), self.encode_part(part[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings."""
        a, b, token = min(RIM, len(left)), min(RIM, len(right)), self.token
        while True:
            window = merge_bytes(b"".join([token[t] for t in left[len(left) - a :] + right[:b]]), self.ranks)
            held_left = a == len(left) or window[0] == left[-a]
            held_right = b == len(right) or window[-1] == right[b - 1]
            if held_left and held_right:
                return left[: len(left) - a] + window + right[b:]
            if not held_left:
                a = min(2 * a, len(left))
            if not held_right:
                b = min(2 * b, len(right))

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one piece as little-endian 32-bit integers; a piece that is a token is that token."""
        part = piece.encode()
        whole = self.ranks.get(part)
        ids = array("I", [whole] if whole is not None else self.encode_part(part))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[piece] = packed = ids.tobytes()
        return packed

    def encode(self, text: str) -> bytes:
        known, encode = self.known, self.encode_piece
        return b"".join([known.get(p) or encode(p) for p in self.pieces.findall(text)])

    def decode(self, ids: Sequence[int], leaf: int = 4096) -> bytes:
        """The bytes of a sequence of ids: those of its halves, joined."""
        if len(ids) <= leaf:
            token = self.token
            return b"".join([token[t] for t in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


def _encoder(files, pattern: str):
    """The encoder of a task's process, made once from the broadcast ranks."""
    if getattr(_encoder, "key", None) != (files.value[0], pattern):
        _encoder.coder, _encoder.key = TreeBpe(files.value[1], pattern), (files.value[0], pattern)
    return _encoder.coder


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all by default), `_ids` (the tokens of the text as little-endian 32-bit integers)
    and `_decoded` (the bytes that they decode to).

    The ranks are read on the driver and broadcast: a vocabulary file does not grow with the data. NULL is encoded like
    the empty text, as no token. Every row stays.
    """
    files = docs.sparkSession.sparkContext.broadcast((path, read_ranks(path)))
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(files, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                packed = [coder.encode(t or "") for t in part[text].to_pylist()]
                decoded = [coder.decode(array("I", p)) for p in packed]
                columns = [part[c] for c in keep] + [pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "_ids", "_decoded"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("_ids", "binary").add("_decoded", "binary")
    return docs.mapInArrow(run, schema)


def token_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of `docs` (doc_id, text).

    NULL and empty texts have no tokens and the hash of nothing; repeated rows stay; an empty table gives no rows.
    """
    coded = encoded(docs.select("doc_id", "text"), path, pattern, keep=["doc_id"])
    n = (F.octet_length("_ids") / 4).cast("bigint")
    return coded.select("doc_id", n.alias("n_tokens"), F.sha2("_ids", 256).alias("ids_sha256"), F.sha2("_decoded", 256).alias("decoded_sha256"))
