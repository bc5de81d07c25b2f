"""Token counts by a finite-state transducer over bytes whose transitions carry the number of emitted tokens.

A state stands for all prefixes of a piece that behave alike from here on: the longest ending that could still become a
token, and for every such ending the token before it and the tokens counted since. A transition on a byte finds the one
token that the longer prefix ends with and emits the change of the count, which may be negative. States and transitions
are compiled on first use. Pieces never span a non-blank followed by a blank, so a text may be cut anywhere: the map of
a chunk is what it counts between its first and last such place, whatever the state it is entered in, together with the
open ends; maps of neighbouring chunks compose, and a scan in pairs composes all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters per chunk; pieces and transitions that a task remembers.
CHUNK = 1 << 15
REMEMBERED = 1_000_000
# The pattern of the byte-level pre-tokenizer.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEAM = regex.compile(r"(?<=\S)(?=\s)")
LAST_SEAM = regex.compile(r"(?r)(?<=\S)(?=\s)")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special strings of a tokenizer file."""

    def __init__(self, content: str) -> None:
        parsed = json.loads(content)
        letters = byte_letters()
        self.tokens = {bytes(letters[c] for c in t) for t in parsed["model"]["vocab"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
        self.merges = {(bytes(letters[c] for c in a), bytes(letters[c] for c in b)): i for i, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.openings = {t[:i] for t in self.tokens for i in range(len(t))}

    def merge(self, part: bytes) -> list[bytes]:
        """The tokens of a short part: merges in the order of their ranks, leftmost first."""
        out, none = [part[i : i + 1] for i in range(len(part))], len(self.merges)
        look = self.merges.get
        near = [look(p, none) for p in zip(out, out[1:])]
        while near:
            best = min(near)
            if best == none:
                break
            i = near.index(best)
            out[i : i + 2] = [out[i] + out[i + 1]]
            del near[i]
            if i < len(near):
                near[i] = look((out[i], out[i + 1]), none)
            if i:
                near[i - 1] = look((out[i - 1], out[i]), none)
        return out


class Transducer:
    """Deterministic states over bytes, compiled as texts need them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pieces = regex.compile(PIECES)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.beside: dict[tuple[bytes, bytes], bool] = {}
        self.known: dict[str, int] = {}
        self._restart()

    def _restart(self) -> None:
        # A state: the open ending, and (length of an ending, token before it, tokens counted since), longest first.
        start = (b"", ((0, None, 0),))
        self.number = {start: 0}
        self.state = [start]
        self.arcs: list[dict[int, tuple[int, int]]] = [{}]

    def neighbours(self, a: bytes, b: bytes) -> bool:
        """Whether the bytes of two tokens are encoded as these two."""
        found = self.beside.get((a, b))
        if found is None:
            found = self.beside[a, b] = self.vocabulary.merge(a + b) == [a, b]
        return found

    def compile_arc(self, at: int, byte: int) -> tuple[int, int]:
        """(next state, change of the count) of one transition."""
        ending, entries = self.state[at]
        ending += bytes((byte,))
        for size, token, since in entries:
            last = ending[len(ending) - size - 1 :]
            if last in self.vocabulary.tokens and (self.neighbours(token, last) if token is not None else self.vocabulary.merge(last) == [last]):
                break
        else:
            raise ValueError(f"no token ends {ending!r}")
        change = 1 - since
        kept = ending
        while kept not in self.vocabulary.openings:
            kept = kept[1:]
        longer = tuple(
            (size + 1, token, since + change)
            for size, token, since in entries
            if size < len(kept) and ending[len(ending) - size - 1 :] in self.vocabulary.openings
        )
        state = (kept, (*longer, (0, last, 0)))
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.state)
            self.state.append(state)
            self.arcs.append({})
        self.arcs[at][byte] = number, change
        return number, change

    def run(self, piece: bytes) -> int:
        """The tokens of one piece."""
        at = total = 0
        arcs = self.arcs
        for byte in piece:
            arc = arcs[at].get(byte)
            at, change = arc if arc is not None else self.compile_arc(at, byte)
            total += change
        return total

    def _first(self, piece: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(self.state) >= REMEMBERED:
            self._restart()
        count = self.known[piece] = self.run(piece.encode())
        return count

    def count_plain(self, text: str) -> int:
        known, first = self.known, self._first
        return sum([known.get(p) or first(p) for p in self.pieces.findall(text)])

    def count_span(self, text: str) -> int:
        """The tokens of a text between two cuts: one per special string, and those of the parts between them."""
        if self.special is None:
            return self.count_plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.count_plain, parts))

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(open beginning, count between the seams, open end); None and no end for a chunk without a seam."""
        first = SEAM.search(chunk)
        if first is None:
            return chunk, None, ""
        begin, end = first.start(), LAST_SEAM.search(chunk).start()
        return chunk[:begin], self.count_span(chunk[begin:end]), chunk[end:]

    def compose(self, a: tuple[str, int | None, str], b: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two neighbouring chunks."""
        if a[1] is None and b[1] is None:
            return self.chunk_map(a[0] + b[0])
        if a[1] is None:
            head, inner, _ = self.chunk_map(a[0] + b[0] + " ")
            first = (a[0] + b[0], 0) if inner is None else (head, self.count_span((a[0] + b[0])[len(head) :]))
            return first[0], first[1] + b[1], b[2]
        joined = a[2] + b[0]
        if b[1] is not None:
            return a[0], a[1] + self.count_span(joined) + b[1], b[2]
        seam = LAST_SEAM.search(joined)
        cut = seam.start() if seam else 0
        return a[0], a[1] + self.count_span(joined[:cut]), joined[cut:]

    def count(self, text: str) -> int:
        """The tokens of a text, from the maps of its chunks composed in pairs."""
        if len(text) <= CHUNK:
            return self.count_span(text)
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(maps) - len(maps) % 2 :]
        head, inner, tail = maps[0]
        return self.count_span(head) + (0 if inner is None else inner + self.count_span(tail))


def _transducer(content) -> Transducer:
    """The transducer of a task's process; what it has compiled serves the next tasks."""
    key, vocabulary = content.value
    if getattr(_transducer, "key", None) != key:
        _transducer.machine, _transducer.key = Transducer(Vocabulary(vocabulary)), key
    return _transducer.machine


def counted(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all by default) and `_n_tokens`: the tokens of a byte-level BPE tokenizer file, without added ones; NULL has none.

    Special strings inside texts count as their one token. The file is read on the driver and broadcast: a vocabulary
    does not grow with the data.
    """
    keep = docs.columns if keep is None else keep
    with open(path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast((path, file.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(content)
        for batch in batches:
            counts = pa.array([machine.count(t or "") for t in batch[text].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], counts], [*keep, "_n_tokens"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep]).add("_n_tokens", "long"))


def count_report(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `docs` (doc_id, text).

    NULL counts as empty and has no tokens; repeated rows are counted each; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    n = F.col("_n_tokens")
    return counted(rows, path, keep=["doc_id", "n_bytes"]).select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
