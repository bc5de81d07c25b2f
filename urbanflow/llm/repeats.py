"""Removal of passages that an earlier document has, by interval expansion on Burrows-Wheeler transforms.

Every string of `LENGTH` bytes names an anchor inside itself, the sequence of `GRAM` bytes of smallest hash, so equal
strings have equal anchors. Neighbouring strings of a document with the same anchor form a fragment. Anchors that only
one document has are dropped first; the fragments of the others meet by anchor, each distinct content once per block of
documents with its smallest document. There, for a lot of anchors at a time, the common prefixes of the suffixes of
fragments that differ are found by backward extension on their transform, breadth first: all intervals of prefixes of
length 0, 1, 2, ... in turn, up to `LENGTH`. What is not separated by then are the occurrences of one string, and the
smallest document among them owns it. A document loses every byte of a string whose owner is a smaller document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.backoff import unzipped, zipped
from urbanflow.llm.blocks import by_part, in_blocks, packed, unpacked

LENGTH, GRAM = 50, 24
# Documents of an anchor from which its fragments are cut into single strings, which are dealt by their own hashes: the
# strings inside a passage that very many documents share collapse, and those with their different surroundings spread.
CROWD = 4096
# Blocks of documents and parts of tables are so many times the usual size: rows are exchanged for each pair of them.
TIMES = 2
# Bytes of texts whose anchors are chosen at once, a longer text by itself, and of fragments with their anchors that one
# transform is built of, an anchor with more by itself; only speed and memory depend on them.
RUN_BYTES, SEARCH_BYTES = 1 << 17, 1 << 18
# Bits of the hashes of anchors and contents. Contents of one hash are compared, and anchors of one hash may be mistaken
# for each other: their contents are then searched together, which finds no more.
HASH_BITS = 40
_LAST = np.int64(2**63 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - HASH_BITS)


class Bytes:
    """Texts one after another, of which words of eight bytes are read from any place."""

    def __init__(self, data: bytes) -> None:
        self.symbols = np.frombuffer(data + bytes(8), np.uint8)
        self._words = np.ndarray((len(data) + 1,), "<u8", self.symbols, 0, (1,))

    def words(self, places: np.ndarray) -> np.ndarray:
        return self._words[places]

    def grams(self, places: np.ndarray) -> np.ndarray:
        """A hash of the `GRAM` bytes from each place."""
        total = np.zeros(len(places), np.uint64)
        for at in range(0, GRAM, 8):
            total = (total ^ self.words(places + at)) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return _mixed(total)

    def strips(self, places: np.ndarray, sizes: np.ndarray, length: int) -> Iterator[np.ndarray]:
        """Words that together hold all bytes of the contents at some places: of `length` bytes at least, and of less
        than twice as many without a sequence of `GRAM`."""
        head = length // 8
        for at in range(head):
            yield self.words(places + 8 * at)
        for at in range(1, -(-(2 * length - GRAM - 8 * head) // 8) + 1):
            yield self.words(places + (sizes - 8 * at))

    def distinct(self, places: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each content, the first of each distinct one, the number of the distinct one that each is)."""
        digest = sizes.astype(np.uint64)
        for strip in self.strips(places, sizes, length):
            digest = (digest ^ strip) * np.uint64(0x9E3779B97F4A7C15)
            digest ^= digest >> np.uint64(29)
        digest = _mixed(digest)
        _, first, number = numbered(digest)
        other = sizes != sizes[first][number]
        for strip in self.strips(places, sizes, length):
            other |= strip != strip[first][number]
        more: dict[bytes, int] = {}  # the few that have the hash of another content
        firsts = []
        for at in np.flatnonzero(other).tolist():
            content = self.symbols[places[at] : places[at] + sizes[at]].tobytes()
            if more.setdefault(content, len(first) + len(more)) == len(first) + len(firsts):
                firsts.append(at)
            number[at] = more[content]
        return digest, np.append(first, np.array(firsts, np.int64)), number

    def cut(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The contents at some places, one after another."""
        return self.symbols[ranges(places, sizes)]


def sorted_keys(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(stable order of keys below 2^`bits`, which of them in that order differ from the one before; the first does)."""
    width = len(keys).bit_length()
    if bits + width <= 64:  # sorting numbers that end in their places is several times faster than ordering places
        packed_keys = np.sort((keys.astype(np.uint64) << np.uint64(width)) | np.arange(len(keys), dtype=np.uint64))
        order = (packed_keys & np.uint64((1 << width) - 1)).astype(np.int64)
        ahead = packed_keys >> np.uint64(width)
    else:
        order = np.argsort(keys, kind="stable")
        ahead = keys[order]
    return order, np.append(True, ahead[1:] != ahead[:-1])[: len(keys)]


def numbered(keys: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order of keys below 2^`bits`, the first place of each distinct one, the number of each among these)."""
    order, new = sorted_keys(keys, bits)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, order[new], number


def ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of every range, one range after another."""
    return np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def gram_ranks(symbols: np.ndarray) -> np.ndarray:
    """A number of 32 bits for the `GRAM` bytes from every place; the smallest among neighbours is their anchor."""
    rank = symbols.astype(np.uint32)
    for width, factor in ((1, 0x85EBCA6B), (2, 0xC2B2AE35), (4, 0x27D4EB2F)):
        rank = rank[:-width] * np.uint32(factor) + rank[width:]
        rank ^= rank >> np.uint32(15)
    rank = (rank[:-16] * np.uint32(0x9E3779B1) + rank[8:-8]) * np.uint32(0x85EBCA77) + rank[16:]
    rank ^= rank >> np.uint32(15)
    rank *= np.uint32(0x2C1B3C6D)
    return rank ^ (rank >> np.uint32(13))


def fragments(symbols: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first string, last string, anchor) of the fragments of texts of `sizes` bytes, one after another in
    `symbols`; the leftmost of equal ranks is the anchor. Strings and anchors are given by their places in `symbols`."""
    strings, window = len(symbols) - length + 1, length - GRAM + 1
    if strings <= 0 or sizes.max() < length:
        return (np.empty(0, np.int64),) * 4
    ranks = gram_ranks(symbols)
    least, width = ranks, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[:strings], least[window - width : window - width + strings])
    # An anchor gives way when the next string begins after it, or when a smaller one comes in at the string's end.
    change = np.empty(strings, bool)
    change[0] = True
    change[1:] = (least[1:] != least[:-1]) | (ranks[: strings - 1] == least[:-1])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    change[begins[sizes >= length]] = True
    # No string crosses into the next text, so neither do the places among which its anchor is chosen.
    tails = np.minimum(sizes, length - 1)
    crossing = ranges(ends - tails, tails)
    change[crossing[crossing < strings]] = False
    first = np.flatnonzero(change)
    bounds = np.searchsorted(first, begins)
    text = np.repeat(np.arange(len(sizes)), np.diff(bounds, append=len(first)))
    last = np.append(first[1:] - 1, 0)
    final = np.append(text[1:] != text[:-1], True)
    last[final] = ends[text[final]] - length
    value = least[first]
    came = least[first] < least[first - 1]
    came[0] &= first[0] > 0
    anchor = np.where(came, first + window - 1, last)
    sought = np.flatnonzero(~came & (ranks[last] != value))
    if len(sought):
        near = np.lib.stride_tricks.sliding_window_view(ranks, window)[first[sought]]
        anchor[sought] = first[sought] + np.argmax(near == value[sought, None], 1)
    return text, first, last, anchor


class Block:
    """The documents of a block in the order of their ids, with their fragments one after another."""

    def __init__(self, rows: pa.Table, length: int) -> None:
        ids = rows["doc_id"].to_pylist()
        texts = unzipped(rows["text"])
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in order]
        self.owner = np.array([_LAST if ids[i] is None else ids[i] for i in order], np.int64)
        self.data = [(texts[i] or "").encode() for i in order]
        self.text = Bytes(b"".join(self.data))
        self.sizes = np.array([len(d) for d in self.data], np.int64)
        ends = np.cumsum(self.sizes)
        run = ends // RUN_BYTES
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(self.data)]
        parts = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            begin = int(ends[a] - self.sizes[a])
            text, *places = fragments(self.text.symbols[begin : int(ends[b - 1])], self.sizes[a:b], length)
            parts.append((text + a, *[p + begin for p in places]))
        self.doc, self.first, self.last, self.anchor = (np.concatenate(x) for x in zip(*parts))
        self.hash = self.text.grams(self.anchor)
        self.order, firsts, self.key = numbered(self.hash)
        self.keys = self.hash[firsts]

    def documents_of_keys(self) -> np.ndarray:
        """How many documents have each key."""
        key, doc = self.key[self.order], self.doc[self.order]
        new = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        return np.bincount(key[new], minlength=len(self.keys))


def hashes_by_part(hashes: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, positions of its hashes), as `by_part`, for hashes of `HASH_BITS`."""
    return by_part(hashes << np.uint64(64 - HASH_BITS), parts)


def anchors_asked(rows: pa.Table, length: int, parts: int) -> pa.Table:
    """(part, block, keys, counts): a block's anchors with the number of its documents that have them."""
    block = Block(rows, length)
    counts, number = block.documents_of_keys(), rows["block"][0].as_py()
    # The parts go by the lowest bits, so the upper ones tell the anchors of a part apart.
    keys = (block.keys >> np.uint64(HASH_BITS - 32)).astype(np.uint32)
    out = [(part, number, keys[p].tobytes(), packed(counts[p])) for part, p in hashes_by_part(block.keys, parts)]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["part", "block", "keys", "counts"])


def anchors_answered(rows: pa.Table, crowd: int) -> pa.Table:
    """(part, block, totals): the documents of every anchor asked for, over all blocks; more than `crowd` as one more."""
    arrays = [np.frombuffer(k, np.uint32) for k in rows["keys"].to_pylist()]
    own = np.concatenate([unpacked(c, len(a)) for c, a in zip(rows["counts"].to_pylist(), arrays)])
    number = numbered(np.concatenate(arrays))[2]
    sums = np.minimum(np.bincount(number, own).astype(np.int64), crowd + 1)
    totals = [packed(x) for x in np.split(sums[number], np.cumsum([len(a) for a in arrays])[:-1])]
    return pa.table([rows["part"], rows["block"], pa.array(totals, pa.binary())], ["part", "block", "totals"])


class Contents:
    """The contents of a block's shared anchors: of every one its place, size, anchor's place in it and document, and
    the number of its distinct content. `first` has the smallest document's, `parts` the numbers by part."""

    def __init__(self, block: Block, answers: pa.Table, length: int, parts: int, crowd: int) -> None:
        totals = np.zeros(len(block.keys), np.int64)
        given = dict(zip(answers["part"].to_pylist(), answers["totals"].to_pylist()))
        for part, places in hashes_by_part(block.keys, parts):
            totals[places] = unpacked(given[part], len(places))
        total = totals[block.key]
        few, many = np.flatnonzero((total > 1) & (total <= crowd)), np.flatnonzero(total > crowd)
        strings = block.last[many] - block.first[many] + 1
        cut = np.repeat(many, strings)
        self.places = np.append(block.first[few], ranges(block.first[many], strings))
        self.sizes = np.append(block.last[few] - block.first[few], np.zeros(len(cut), np.int64)) + length
        self.anchors = np.append(block.anchor[few], block.anchor[cut]) - self.places
        self.docs = np.append(block.doc[few], block.doc[cut])
        digest, self.first, self.number = block.text.distinct(self.places, self.sizes, length)
        dealt = np.append(block.hash[few], digest[len(few) :])
        self.parts = hashes_by_part(dealt[self.first], parts)


def fragments_asked(rows: pa.Table, answers: pa.Table, length: int, parts: int, crowd: int) -> pa.Table:
    """(part, block, sizes, places, bytes, owners): distinct contents of a block, packed, with the smallest document of each."""
    block, out = Block(rows, length), []
    number = rows["block"][0].as_py()
    found = Contents(block, answers, length, parts, crowd)
    for part, numbers in found.parts:
        at = found.first[numbers]
        sizes, anchors = found.sizes[at].astype(np.uint16), found.anchors[at].astype(np.uint8)
        data, owners = block.text.cut(found.places[at], found.sizes[at]), block.owner[found.docs[at]]
        out.append((part, number, sizes.tobytes(), anchors.tobytes(), pa.compress(data.tobytes(), "zstd", asbytes=True), owners.tobytes()))
    columns = list(zip(*out)) or [[]] * 6
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "block", "sizes", "places", "bytes", "owners"])


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the next `depth` symbols at least; symbols are below 512."""
    n = len(symbols)
    place_bits = n.bit_length()
    width = max((63 - place_bits) // 9, 3)
    key = np.zeros(n, np.int64)  # symbols of nine bits, zeros beyond the end
    for at in range(width):
        key <<= 9
        key[: max(n - at, 0)] |= symbols[at:]
    bits = 9 * width
    while True:
        order, new = sorted_keys(key, bits)
        if width >= depth or width >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        key = rank << place_bits
        key[:-width] += rank[width:] + 1
        width, bits = 2 * width, 2 * place_bits


def prefix_borders(transform: np.ndarray, depth: int) -> np.ndarray:
    """Whether neighbours in suffix order differ in their first `depth` symbols, from the transform alone.

    The interval of a prefix w is extended backward: the occurrences of a symbol c in it are, in order, the suffixes
    that start with c w. Intervals are taken up by increasing length, so the first to end at a border has as its length
    less one the common prefix there; intervals that end at a known border lead to nothing new.
    """
    n = len(transform)
    border = np.zeros(n + 1, bool)
    order = np.argsort(transform, kind="stable")
    follow = np.empty(n, np.int32 if n < 1 << 31 else np.int64)  # where the suffix that starts one symbol earlier stands
    follow[order] = np.arange(n)
    symbols = transform[order]
    left, right = np.array([0]), np.array([n])
    for _ in range(depth):
        sizes = right - left
        places = np.repeat(left - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
        at = follow[places]
        to = np.sort(at)
        # In one interval the suffixes of one symbol are a run; runs of different intervals may touch, so the interval
        # and the symbol are compared, not the gap.
        from_interval = np.empty(n, follow.dtype)
        from_interval[at] = np.repeat(np.arange(len(left)), sizes)
        symbol = symbols[to]
        own = from_interval[to]
        new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1]) | (to[1:] != to[:-1] + 1)]))
        begin = to[new]
        end = begin + np.diff(np.append(new, len(to)))
        fresh = ~border[end]
        border[end[fresh]] = True
        left, right = begin[fresh], end[fresh]
        if not len(left):
            break
    return border[1:n]


def owners_of_strings(data: np.ndarray, sizes: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """The smallest owner, over all pieces, of each string of `length` bytes in each piece, one piece after another.

    `data` has the pieces, of `sizes` bytes, one after another.
    """
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.ones(len(data) + len(sizes), np.int16)
    symbols[ranges(begins, sizes)] = data.astype(np.int16) + 2
    symbols[-1] = 0
    suffixes = sorted_suffixes(symbols, length)
    border = prefix_borders(symbols[suffixes - 1], length)
    group = np.concatenate([[0], np.cumsum(border)])
    piece = np.repeat(np.arange(len(sizes)), sizes + 1)
    least = np.minimum.reduceat(owners[piece[suffixes]], np.flatnonzero(np.concatenate([[True], border])))
    smallest = np.empty(len(symbols), np.int64)
    smallest[suffixes] = least[group]
    return smallest[ranges(begins, sizes - length + 1)]


def searched(anchors: np.ndarray, sizes: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Positions of contents that may share strings with others of their anchor, in lots of about `SEARCH_BYTES`.

    A content alone with its anchor shares none, and distinct contents of one string each share none with each other.
    """
    order, _, number = numbered(anchors)
    together = np.bincount(number)
    longest = np.zeros(len(together), np.int64)
    np.maximum.at(longest, number, sizes)
    mixed = order[((together > 1) & (longest > length))[number[order]]]
    if len(mixed):
        lot = np.cumsum(sizes[mixed]) // SEARCH_BYTES
        # The contents of an anchor stay together, in the lot of the first.
        starts = np.flatnonzero(np.diff(number[mixed], prepend=-1))
        lot = np.repeat(lot[starts], np.diff(starts, append=len(mixed)))
        yield from np.split(mixed, np.flatnonzero(np.diff(lot)) + 1)


def fragments_answered(rows: pa.Table, length: int) -> pa.Table:
    """(part, block, owners): for every content asked for, the owners of its strings, one after another."""
    asked = [np.frombuffer(s, np.uint16) for s in rows["sizes"].to_pylist()]
    sizes = np.concatenate(asked).astype(np.int64)
    anchors = np.frombuffer(b"".join(rows["places"].to_pylist()), np.uint8)
    owners = np.frombuffer(b"".join(rows["owners"].to_pylist()), np.int64)
    data = (pa.decompress(c, int(s.sum()), "zstd", asbytes=True) for c, s in zip(rows["bytes"].to_pylist(), asked, strict=True))
    text = Bytes(b"".join(data))
    places = np.cumsum(sizes) - sizes
    _, first, number = text.distinct(places, sizes, length)
    least = np.full(len(first), _LAST)
    np.minimum.at(least, number, owners)
    counts = sizes[first] - (length - 1)
    begins = np.cumsum(counts) - counts
    found = np.repeat(least, counts)
    for lot in searched(text.grams(places[first] + anchors[first]), sizes[first], length):
        at = first[lot]
        found[ranges(begins[lot], counts[lot])] = owners_of_strings(text.cut(places[at], sizes[at]), sizes[at], least[lot], length)
    out = [found[ranges(begins[own], counts[own])].tobytes() for own in np.split(number, np.cumsum([len(a) for a in asked])[:-1])]
    return pa.table([rows["part"], rows["block"], pa.array(out, pa.binary())], ["part", "block", "owners"])


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that some ranges cover together."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, starts[1:] > reach[:-1])[: len(starts)])
    return starts[new], reach[np.append(new[1:], len(starts))[: len(new)] - 1]


def removed_bytes(rows: pa.Table, answers: pa.Table, length: int, parts: int, crowd: int) -> pa.Table:
    """(doc_id, text, starts, ends): the maximal removed runs of every document of a block, in bytes."""
    block = Block(rows, length)
    anchors = answers.filter(pa.compute.is_valid(answers["totals"]))
    given = {p: o for p, o in zip(answers["part"].to_pylist(), answers["owners"].to_pylist()) if o is not None}
    found = Contents(block, anchors, length, parts, crowd)
    starts = ends = np.empty(0, np.int64)
    if len(found.first):
        owners = np.concatenate([np.frombuffer(given[part], np.int64) for part, _ in found.parts])
        sent = np.concatenate([numbers for _, numbers in found.parts])
        counts = found.sizes[found.first[sent]] - (length - 1)
        begins = np.cumsum(counts) - counts
        low, high, begin = (np.empty(len(sent), np.int64) for _ in range(3))
        low[sent], high[sent], begin[sent] = np.minimum.reduceat(owners, begins), np.maximum.reduceat(owners, begins), begins
        own = block.owner[found.docs]
        # One byte lies between texts, so that their runs stay apart.
        places, strings = found.places + found.docs, found.sizes - (length - 1)
        whole = np.flatnonzero(high[found.number] < own)
        some = np.flatnonzero((low[found.number] < own) & (high[found.number] >= own))
        at = ranges(places[some], strings[some])
        at = at[owners[ranges(begin[found.number[some]], strings[some])] < np.repeat(own[some], strings[some])]
        starts, ends = merged(np.append(places[whole], at), np.append(places[whole] + found.sizes[whole], at + length))
    offsets = np.cumsum(block.sizes + 1) - block.sizes - 1
    cuts = np.searchsorted(starts, np.append(offsets, offsets[-1] + block.sizes[-1] + 1))
    shift = np.repeat(offsets, np.diff(cuts))
    lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x - shift, pa.int64())) for x in (starts, ends)]
    return pa.table([pa.array(block.ids, rows["doc_id"].type), pa.array(block.data, pa.binary()), *lists], ["doc_id", "bytes", "starts", "ends"])


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, bytes, starts, ends) of every row of `docs` (doc_id, text): the runs of its UTF-8 bytes that are covered
    by strings of `length` bytes which a document with a smaller id has too.

    NULL texts are empty. A NULL id is larger than all others. Rows that share an id do not remove from each other.
    """
    if length < GRAM:
        raise ValueError(f"strings have at least {GRAM} bytes")
    rows, _, parts = in_blocks(docs.select("doc_id", "text"), times=TIMES, pack=zipped)
    parts, crowd = (parts - 1) // TIMES + 1, CROWD
    by_block = rows.groupBy("block")
    asked = by_block.applyInArrow(lambda t: anchors_asked(t, length, parts), "part long, block long, keys binary, counts binary")
    anchors = asked.groupBy("part").applyInArrow(lambda t: anchors_answered(t, crowd), "part long, block long, totals binary")
    wanted = by_block.cogroup(anchors.groupBy("block")).applyInArrow(
        lambda a, b: fragments_asked(a, b, length, parts, crowd),
        "part long, block long, sizes binary, places binary, bytes binary, owners binary",
    )
    owned = wanted.groupBy("part").applyInArrow(lambda t: fragments_answered(t, length), "part long, block long, owners binary")
    answers = anchors.withColumn("owners", F.lit(None).cast("binary")).unionByName(owned.withColumn("totals", F.lit(None).cast("binary")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        lambda a, b: removed_bytes(a, b, length, parts, crowd), f"doc_id {kind}, bytes binary, starts array<bigint>, ends array<bigint>"
    )


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of `docs`; an empty table gives no rows."""
    runs = repeated_runs(docs, length)
    gaps = F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(0).cast("bigint")), "ends").alias("a"), F.concat("starts", F.array(F.octet_length("bytes").cast("bigint"))).alias("b")),
        lambda z: F.substr(F.col("bytes"), (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int")),
    )
    kept = F.aggregate(gaps, F.lit(b""), lambda a, x: F.concat(a, x))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return runs.select(
        "doc_id", F.octet_length("bytes").cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"),
    )
