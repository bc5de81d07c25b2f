"""Repair of damaged conversations by a cost program and prefix-doubling path ranking.

A conversation in good form has the roles `(s?(ua)+)?`: perhaps a system turn, then pairs of user and assistant. Rows
are kept, given another role, deleted, and empty rows are inserted, at the least cost. The costs of what is left to do
come from products of small min-plus matrices by doubling, so no row is visited one by one. Arcs of least cost form
a graph; its nodes are ranked by the edits that follow them, first by one letter, then by two, four and so on, each time
through pointers that are doubled. The ranks select the least path, and the doubled pointers list its nodes.

A conversation is worked on in blocks of rows: costs are carried from its end to its start, the path the other way.
Only one byte a row is held for all of it; texts are never gathered, they pass through the hash one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.session import materialize

# Costs of the edits, and of a row that stays though it is truncated.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 40
# States: nothing yet, after system, after user, after assistant.
STATES = 4
# Where each state goes on s, u, a; -1 is nowhere. A row inserted or given another role is user or assistant.
_NEXT = np.array([[1, 2, -1], [-1, 2, -1], [-1, -1, 3], [-1, 2, -1]])
_MADE = [1, 1, 2, 1]  # the role, as a column of _NEXT, that an inserted row or another role can have in each state
_AT_END = np.array([0, 2 * INSERT, INSERT, 0])
ROLES = [None, "user", "assistant"]
# Letters of the edits in ASCII order: their ranks.
LETTERS = b"DIKR"
_D, _I, _K, _R = range(4)
# Rows that are worked on at once; only memory and speed depend on it.
BLOCK_ROWS = 1 << 16
# What a row without a visible character consists of.
BLANKS = " \t\n\x0b\x0c\r"
# Kinds of rows: the first letter of the role (s, u, a, another one), plus these for the first fault.
OTHER, FAULT_BLANK, FAULT_DUPLICATE, FAULT_TRUNCATED = 3, 4, 8, 12


def _row_arcs(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row, state and letter: the cost of the edit and the state after it (inserts stay before the same row)."""
    letter, fault = kinds % 4, kinds // 4 * 4
    gone = (fault == FAULT_BLANK) | (fault == FAULT_DUPLICATE)
    stays = np.where(fault == FAULT_TRUNCATED, TRUNCATED, 0)
    cost = np.full((len(kinds), STATES, 4), FAR, np.int64)
    to = np.zeros((len(kinds), STATES, 4), np.int64)
    for state in range(STATES):
        made = _NEXT[state, _MADE[state]]
        cost[:, state, _D], to[:, state, _D] = DELETE, state
        cost[:, state, _I], to[:, state, _I] = INSERT, made
        cost[:, state, _R], to[:, state, _R] = np.where(gone, FAR, REROLE + stays), made
        kept = np.append(_NEXT[state], -1)[letter]
        cost[:, state, _K], to[:, state, _K] = np.where(gone | (kept < 0), FAR, stays), np.maximum(kept, 0)
    return cost, to


def _row_matrices(cost: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Min-plus matrices from the state before a row, with inserts there, to the state after it."""
    step = np.full((len(cost), STATES, STATES), FAR, np.int64)
    rows = np.arange(len(cost))
    for state in range(STATES):
        for letter in (_D, _K, _R):
            at = (rows, state, to[:, state, letter])
            step[at] = np.minimum(step[at], cost[:, state, letter])
    return _product(np.broadcast_to(_INSERTS, step.shape), step)


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.full(x.shape, FAR, np.int64)
    for k in range(STATES):
        np.minimum(out, x[:, :, k, None] + y[:, None, k, :], out=out)
    return np.minimum(out, FAR)


def _closure() -> np.ndarray:
    """The least cost of inserts between any two states."""
    one = np.full((1, STATES, STATES), FAR, np.int64)
    for state in range(STATES):
        one[0, state, state] = 0
        one[0, state, _NEXT[state, _MADE[state]]] = INSERT
    return _product(one, _product(one, one))[0]


_INSERTS = _closure()


def costs_to_go(kinds: np.ndarray, group: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least cost from each row and state to the end; `group` numbers the runs of rows, `end[run]` has the costs after it.

    After round k a row's matrix covers the 2 ** k rows from it on, or all that are left of its run.
    """
    total = _row_matrices(*_row_arcs(kinds))
    reach = 1
    while reach < len(kinds):
        same = np.flatnonzero(group[:-reach] == group[reach:])
        if not len(same):
            break
        total[same] = _product(total[same], total[same + reach])
        reach *= 2
    return np.minimum((total + end[group][:, None, :]).min(axis=2), FAR)


def rank_nodes(first: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of nodes by the letters on the path from each, and the pointers after 1, 2, 4, ... letters.

    `first` is the rank of the first letter, 0 for an end, which points to itself. Paths that are the start of another
    come before it. Rounds end when every pointer has reached an end.
    """
    rank, pointers = first, [target]
    while True:
        pair = rank * (int(rank.max(initial=0)) + 1) + rank[pointers[-1]]
        _, better = np.unique(pair, return_inverse=True)
        further = pointers[-1][pointers[-1]]
        done = np.array_equal(further, pointers[-1])
        pointers.append(further)
        rank = better
        if done:
            return rank, pointers


def least_paths(kinds: np.ndarray, group: np.ndarray, end: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """(run, row, letter, state) of the edits of every run, in order, on the path of least cost whose letters are least.

    `start[run]` is the state before the run and `end[run]` has the costs of the four states after it.
    """
    n, runs = len(kinds), len(end)
    left = costs_to_go(kinds, group, end)
    cost, to = _row_arcs(kinds)
    last = np.append(group[1:] != group[:-1], True) if n else np.empty(0, bool)
    # Nodes: (row, state), then per run an end for each state.
    node = np.arange(n * STATES).reshape(n, STATES)
    after = np.where(last[:, None], n * STATES + group[:, None] * STATES + np.arange(STATES), np.roll(node, -1, axis=0)) if n else node
    after_cost = np.where(last[:, None], end[group], np.roll(left, -1, axis=0)) if n else left
    rows = np.arange(n)[:, None]
    targets = np.empty((n, STATES, 4), np.int64)
    costs = np.empty((n, STATES, 4), np.int64)
    for letter in range(4):
        same_row = letter == _I
        targets[:, :, letter] = (node if same_row else after)[rows, to[:, :, letter]]
        costs[:, :, letter] = cost[:, :, letter] + (left if same_row else after_cost)[rows, to[:, :, letter]]
    best = costs == left[:, :, None]
    # The letters of a node's arcs differ, so the least letter is the first round's rank and gives the pointer to double.
    letter = best.argmax(axis=2)
    total = n * STATES + runs * STATES
    first, target = np.zeros(total, np.int64), np.arange(total)
    first[: n * STATES] = (letter + 1).ravel()
    target[: n * STATES] = np.take_along_axis(targets, letter[:, :, None], axis=2).ravel()
    rank, pointers = rank_nodes(first, target)
    # Of the arcs of least cost, the one whose letter and following rank come first is taken.
    follows = np.where(best, np.arange(4) * (int(rank.max(initial=0)) + 1) + rank[targets], np.iinfo(np.int64).max)
    letter = follows.argmin(axis=2)
    begin = np.full(runs, -1)
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.empty(0, np.int64)
    begin[group[heads]] = heads * STATES + start[group[heads]]
    # The path's nodes in order: those after 2 ** k letters follow those before.
    path = begin[begin >= 0][:, None]
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]], axis=1)
        if (path[:, -1] >= n * STATES).all():
            break
    inside = path < n * STATES
    run = np.repeat(np.flatnonzero(begin >= 0), inside.sum(axis=1))
    nodes = path[inside]
    exits = np.array(start)
    stop = np.take_along_axis(path, inside.sum(axis=1)[:, None], axis=1)[:, 0] if len(path) else np.empty(0, np.int64)
    exits[begin >= 0] = (stop - n * STATES) % STATES
    return run, nodes // STATES, letter.ravel()[nodes], nodes % STATES, exits, left


def end_inserts(state: int) -> list[int]:
    """States before the inserts that lead from a state to a good end."""
    out = []
    while _AT_END[state]:
        out.append(state)
        state = int(_NEXT[state, _MADE[state]])
    return out


class Edits:
    """The edits of one conversation: letters, and the rows that stay as (row, role or None for its own)."""

    def __init__(self) -> None:
        self.audit: list[bytes] = []
        self.rows: list[np.ndarray] = []
        self.made: list[np.ndarray] = []
        self.cost = 0


def _collect(edits: Edits, offset: int, rows: np.ndarray, letters: np.ndarray, states: np.ndarray) -> None:
    edits.audit.append(bytes(np.frombuffer(LETTERS, np.uint8)[letters]))
    stays = letters != _D
    row = np.where(letters == _I, -1, rows + offset)
    made = np.where(letters == _K, 0, np.array(_MADE)[states])
    edits.rows.append(row[stays])
    edits.made.append(made[stays])


def _finish(edits: Edits, state: int) -> None:
    for before in end_inserts(state):
        _collect(edits, 0, np.zeros(1, np.int64), np.array([_I]), np.array([before]))


def repair_many(kinds: np.ndarray, group: np.ndarray, count: int) -> list[Edits]:
    """Edits of conversations 0 to count - 1, given by the kinds of all their rows in order."""
    out = [Edits() for _ in range(count)]
    start = np.zeros(count, np.int64)
    run, rows, letters, states, exits, left = least_paths(kinds, group, np.tile(_AT_END, (count, 1)), start)
    heads = np.searchsorted(group, np.arange(count))
    bounds = np.searchsorted(run, np.arange(count + 1))
    for i, edits in enumerate(out):
        at = slice(bounds[i], bounds[i + 1])
        _collect(edits, -int(heads[i]), rows[at], letters[at], states[at])
        _finish(edits, int(exits[i]))
        edits.cost = int(left[heads[i], 0]) if heads[i] < len(group) and group[heads[i]] == i else 0
    return out


def repair_long(kinds: np.ndarray) -> Edits:
    """Edits of one conversation of any length, block by block."""
    blocks = [kinds[i : i + BLOCK_ROWS] for i in range(0, len(kinds), BLOCK_ROWS)]
    ends = [_AT_END]
    for block in reversed(blocks[1:]):
        ends.append(costs_to_go(block, np.zeros(len(block), np.int64), ends[-1][None])[0])
    edits, state = Edits(), 0
    for i, (block, end) in enumerate(zip(blocks, reversed(ends))):
        start = np.array([state])
        _, rows, letters, states, exits, left = least_paths(block, np.zeros(len(block), np.int64), end[None], start)
        if i == 0:
            edits.cost = int(left[0, 0])
        _collect(edits, i * BLOCK_ROWS, rows, letters, states)
        state = int(exits[0])
    _finish(edits, state)
    return edits


def illegal_pairs(kinds: np.ndarray) -> int:
    """Neighbours whose roles do not follow each other."""
    letters = kinds % 4
    pair = letters[:-1] * 4 + letters[1:]
    return int((~np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])).sum())


_EDITS = T.StructType().add("conv", "string")
for _name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
    _EDITS = _EDITS.add(_name, "long")
_EDITS = _EDITS.add("audit", "string").add("seq", "long").add("h", "binary").add("role", "string")


def _told(conv: str, kinds: np.ndarray, hashes: np.ndarray, gaps: int, edits: Edits) -> Iterator[pa.RecordBatch]:
    """The report of a conversation (seq is NULL), then the rows that stay: their hash, or none, and a role that is not their own."""
    fault = kinds // 4 * 4
    counts = [int((fault == f).sum()) for f in (FAULT_BLANK, FAULT_DUPLICATE, FAULT_TRUNCATED)]
    report = [conv, gaps, *counts, illegal_pairs(kinds), edits.cost, b"".join(edits.audit).decode(), None, None, None]
    yield pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(report, _ARROW)], _EDITS.names)
    seq = 0
    for rows, made in zip(edits.rows, edits.made):
        for i in range(0, len(rows), BLOCK_ROWS):
            r, m = rows[i : i + BLOCK_ROWS], made[i : i + BLOCK_ROWS]
            h = [hashes[x].tobytes() if x >= 0 else None for x in r]
            columns = [[conv] * len(r), *[[None] * len(r)] * 7, range(seq, seq + len(r)), h, [ROLES[x] for x in m]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f) for v, f in zip(columns, _ARROW)], _EDITS.names)
            seq += len(r)


_ARROW = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.binary(), pa.string()]


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by conversation and place to reports and rows that stay; many short conversations at once."""
    waiting: list[tuple[str, np.ndarray, np.ndarray, int]] = []
    held = 0

    def solve() -> Iterator[pa.RecordBatch]:
        if waiting:
            sizes = [len(w[1]) for w in waiting]
            group = np.repeat(np.arange(len(waiting)), sizes)
            for (conv, kinds, hashes, gaps), edits in zip(waiting, repair_many(np.concatenate([w[1] for w in waiting]), group, len(waiting))):
                yield from _told(conv, kinds, hashes, gaps, edits)

    for conv, parts in _conversations(batches):
        kinds = np.concatenate([p[0] for p in parts])
        hashes, gaps = np.concatenate([p[1] for p in parts]), _gaps(parts)
        if len(kinds) > BLOCK_ROWS:
            yield from _told(conv, kinds, hashes, gaps, repair_long(kinds))
            continue
        waiting.append((conv, kinds, hashes, gaps))
        held += len(kinds)
        if held >= BLOCK_ROWS // 4:
            yield from _packed(solve())
            waiting, held = [], 0
    yield from _packed(solve())


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = list(batches)
    if found:
        yield from pa.Table.from_batches(found).combine_chunks().to_batches(max_chunksize=10_000)


def _gaps(parts: list[tuple]) -> int:
    """Turns missing between the first and the last; places are in order of turns, so these are runs of equal turns."""
    turns = np.concatenate([p[2] for p in parts])
    return int(turns[-1] - turns[0] + 1 - (1 + int((turns[1:] != turns[:-1]).sum()))) if len(turns) else 0


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple]]]:
    """(conversation, parts of its kinds, hashes and turns that are not NULL); repeated rows are spread out."""
    conv, parts = None, []
    for batch in batches:
        names = batch["conv"].to_pylist()
        kinds, copies = batch["kind"].to_numpy().astype(np.uint8), batch["copies"].to_numpy()
        hashes = np.frombuffer(b"".join(batch["h"].to_pylist()), "V16") if len(names) else np.empty(0, "V16")
        turns = batch["turn"].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        there = batch["turn"].is_valid().to_numpy(zero_copy_only=False)
        begins = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
        for a, b in zip(begins[:-1], begins[1:]):
            if a == b:
                continue
            if names[a] != conv:
                if parts:
                    yield conv, parts
                conv, parts = names[a], []
            parts.append((np.repeat(kinds[a:b], copies[a:b]), np.repeat(hashes[a:b], copies[a:b]), turns[a:b][there[a:b]]))
    if parts:
        yield conv, parts


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, sha256) from lines sorted by conversation and place; lines pass through the hash one by one."""
    conv, state, out = None, None, []
    for batch in batches:
        for name, line in zip(batch["conv"].to_pylist(), batch["line"].cast(pa.binary()).to_pylist()):
            if name != conv:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = name, hashlib.sha256(line)
            else:
                state.update(b"\n")
                state.update(line)
    if state is not None:
        out.append((conv, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out])], ["conv", "repaired_sha256"])


def last_visible(text: Column) -> Column:
    """The last character that is not blank, empty where there is none."""
    return F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)


def _keyed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with a text for the conversation that is there for NULL, too; NULL role and text are a blank."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return rows.select(
        conv.alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports and lines of the conversations in `rows` (conv_id, turn, role, text), of which `conv` is the key.

    Reports are (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), lines (conv, seq, line) the repaired
    `role:text` in order. Rows are taken by turn, NULL first, equal turns by role and then by the hash of role and text.
    Repeated rows are copies, each with its own place. A NULL role or text is one blank; a role is known by its first
    letter, and one that begins with none of s, u and a cannot be kept. No rows give no conversations.
    """
    told = _keyed(rows)
    text, role = F.col("text"), F.col("role")
    h = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    last = last_visible(text)
    letter = F.coalesce(F.element_at(F.create_map(F.lit("s"), F.lit(0), F.lit("u"), F.lit(1), F.lit("a"), F.lit(2)), F.substring(role, 1, 1)), F.lit(OTHER))
    fault = F.when(last == "", FAULT_BLANK).when(~last.isin(".", "!", "?"), FAULT_TRUNCATED).otherwise(0)
    narrow = told.select("conv", "turn", "role", h.alias("h"), letter.alias("letter"), fault.alias("fault"))
    keys = ["conv", "turn", "role", "h", "letter", "fault"]
    counted = materialize(narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    first = counted.where(F.col("fault") != FAULT_BLANK).groupBy("conv", "h").agg(F.min(place).alias("first"))
    marked = counted.join(first, ["conv", "h"], "left")
    seen = (F.col("fault") != FAULT_BLANK) & ((F.col("first.there") < F.col("turn").isNotNull()) | F.coalesce(F.col("first.turn") < F.col("turn"), F.lit(False)))
    # The first of equal rows is judged by itself, its copies are duplicates; blank ones stay blank.
    whole, again = F.col("fault") + F.col("letter"), F.col("letter") + FAULT_DUPLICATE
    split = F.when(F.col("fault") == FAULT_BLANK, F.array(F.struct(F.lit(0).alias("part"), whole.alias("kind"), F.col("copies").alias("copies"))))
    split = split.when(seen, F.array(F.struct(F.lit(0).alias("part"), again.alias("kind"), F.col("copies").alias("copies"))))
    split = split.otherwise(F.array(
        F.struct(F.lit(0).alias("part"), whole.alias("kind"), F.lit(1).cast("long").alias("copies")),
        F.struct(F.lit(1).alias("part"), again.alias("kind"), (F.col("copies") - 1).alias("copies")),
    ))
    listed = marked.select("conv", "turn", "role", "h", F.explode(split).alias("s")).select("conv", "turn", "role", "h", "s.*").where("copies > 0")
    ordered = listed.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "h", "part")
    edits = materialize(ordered.select("conv", "turn", "h", "kind", "copies").mapInArrow(_edited, _EDITS))

    stay = edits.where("seq IS NOT NULL")
    texts = told.select("conv", h.alias("h"), F.col("role").alias("own"), "text").dropDuplicates(["conv", "h"])
    lines = stay.join(texts, ["conv", "h"], "left")
    line = F.concat(F.coalesce("role", "own"), F.lit(":"), F.coalesce("text", F.lit("")))
    reports = edits.where("seq IS NULL").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return reports, lines.select("conv", "seq", line.alias("line"))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage chosen by the checksum of `conv_id:turn`; NULL counts as one blank in all four."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    given = rows.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return given.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def repair_report(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id of `rows`
    after damage; one of which nothing is left has zeros, an empty audit and the hash of nothing."""
    left = damaged(rows)
    reports, lines = repaired(left)
    sums = lines.repartition("conv").sortWithinPartitions("conv", "seq").mapInArrow(_hashed, "conv string, repaired_sha256 string")
    ids = rows.groupBy("conv_id").agg(F.lit(0).alias("_")).select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"))
    found = ids.join(reports, "conv", "left").join(sums, "conv", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _oracle() -> str:
    """The same rows in SQL: every state carries its cheapest edits, of equal ones the least, from row to row."""

    def put(x: str, cost: str, letter: str, line: str | None = None) -> str:
        rows = f"{x}.t" if line is None else f"list_append({x}.t, {line})"
        return f"struct_pack(c := {x}.c + {cost}, a := {x}.a || '{letter}', t := {rows})"

    def made(x: str, letter: str, cost: str, role: str, text: str) -> str:
        return put(x, cost, letter, f"'{role}:' || {text}")

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    insert2 = least("p2", *[made(p, "I", "2", "user", "''") for p in ("p0", "p1", "p3")])
    closed = f"p0 AS q0, p1 AS q1, {insert2} AS q2"
    q3 = least("p3", made("q2", "I", "2", "assistant", "''"))
    kept = "(CASE WHEN gone OR letter <> '{0}' THEN 1000000000 ELSE stays END)"
    again = "(CASE WHEN gone THEN 1000000000 ELSE 2 + stays END)"
    own = "role || ':' || text"
    steps = [
        put("q0", "3", "D"),
        least(put("q1", "3", "D"), put("q0", kept.format("s"), "K", own)),
        least(put("q2", "3", "D"), *[put(q, kept.format("u"), "K", own) for q in ("q0", "q1", "q3")], *[made(q, "R", again, "user", "text") for q in ("q0", "q1", "q3")]),
        least(put("q3", "3", "D"), put("q2", kept.format("a"), "K", own), made("q2", "R", again, "assistant", "text")),
    ]
    first = "struct_pack(c := CAST({} AS BIGINT), a := '', t := CAST([] AS VARCHAR[]))"
    crc = """xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT)), lambda c, b: list_reduce(
        [xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END), 4294967295), 4294967295)"""
    return f"""
    WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    kinds AS (SELECT *, {crc} % 20 AS kind FROM given),
    damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text), copy) AS i,
        role[1] AS letter, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank FROM damaged),
    seen AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
        lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS pair FROM numbered),
    judged AS (SELECT *, blank OR duplicate AS gone, CASE WHEN NOT blank AND NOT duplicate
        AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 1 ELSE 0 END AS stays FROM seen),
    walk AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, {first.format(0)} AS p0, {", ".join(f"{first.format(1000000000)} AS p{k}" for k in (1, 2, 3))}
      FROM (SELECT DISTINCT conv_id FROM judged)
      UNION ALL
      SELECT conv_id, i, {", ".join(f"{x} AS p{k}" for k, x in enumerate(steps))}
      FROM (SELECT *, {q3} AS q3 FROM (SELECT w.conv_id, r.i, r.role, r.text, r.letter, r.gone, r.stays, p3, {closed}
            FROM walk w JOIN judged r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))),
    counts AS (SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
        count(*) FILTER (WHERE duplicate) AS duplicate, sum(stays) AS truncated,
        count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
    ended AS (SELECT c.*, {least("p0", "q3")} AS best FROM (SELECT *, {q3} AS q3 FROM (SELECT conv_id, i, p3, p0, {insert2} AS q2 FROM walk)) w
        JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
        CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
        CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
        sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
    FROM ids LEFT JOIN ended e ON ids.conv_id IS NOT DISTINCT FROM e.conv_id"""


ORACLE = _oracle()
