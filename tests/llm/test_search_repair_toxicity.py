"""Ranked search, conversation repair and toxicity against brute force, and on NULLs, ties, repeated rows and empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflow.llm import conversations as C
from urbanflow.llm import fixity, lexical, toxicity

SF = "/root/testdata/sf0.001"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranks(docs, items, top=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // max(n_terms, 1)
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bucket", [256, 3])
def test_search_equals_all_scores(spark, monkeypatch, bucket):
    rng = random.Random(bucket)
    words = [f"w{k}" for k in range(60)] + ["Straße", "中文", "x_y"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 400])))) for i in range(120)]
    docs += [(5, "w1 w2 W1"), (5, "w1 w2 W1"), (None, "w1 w2 w1"), (900, None), (901, "w3 " * 30_000), (902, ""), (903, "...")]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 20])))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (3, "w1 w1 w2"), (None, "w7")]
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    if bucket == 3:
        monkeypatch.setattr(lexical, "CHUNK_BYTES", 300)
        monkeypatch.setattr(lexical, "PART_BYTES", 4000)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("clash"))
    assert rows_of(lexical.ranked(table, bench)) == brute_ranks(docs, items)
    assert lexical.ranked(table.limit(0), bench).count() == 0
    assert lexical.ranked(table, bench.limit(0)).count() == 0


def brute_edits(kinds):
    """Least (cost, audit, rows) per state, row by row; rows are (index or None, role or None)."""
    roles = {0: "s", 1: "u", 2: "a"}
    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insert(best):
        out = dict(best)
        for _ in range(3):
            for state, (c, a, r) in list(out.items()):
                role = "a" if state == 2 else "u"
                option = (c + 2, a + "I", [*r, (None, role)])
                if out.get(to[state, role], (10**9, "")) [:2] > option[:2]:
                    out[to[state, role]] = option
        return out

    best = {0: (0, "", [])}
    for i, kind in enumerate(kinds):
        letter, fault = roles.get(kind % 4), kind // 4 * 4
        gone, stays = fault in (C.FAULT_BLANK, C.FAULT_DUPLICATE), int(fault == C.FAULT_TRUNCATED)
        new = {}
        for state, (c, a, r) in insert(best).items():
            made = "a" if state == 2 else "u"
            options = [(state, (c + 3, a + "D", r))]
            if not gone:
                options.append((to[state, made], (c + 2 + stays, a + "R", [*r, (i, made)])))
                if (state, letter) in to:
                    options.append((to[state, letter], (c + stays, a + "K", [*r, (i, None)])))
            for target, option in options:
                if new.get(target, (10**9, ""))[:2] > option[:2]:
                    new[target] = option
        best = new
    best = insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def test_repairs_equal_all_edits(monkeypatch):
    rng = random.Random(4)
    kinds = [np.array([rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, 4, 8, 12]) for _ in range(rng.randint(1, 14))], np.uint8) for _ in range(300)]
    group = np.repeat(np.arange(len(kinds)), [len(k) for k in kinds])
    together = C.repair_many(np.concatenate(kinds), group, len(kinds))
    for block in (1 << 16, 4, 1):
        monkeypatch.setattr(C, "BLOCK_ROWS", block)
        for one, many in zip(kinds, together):
            cost, audit, rows = brute_edits(one.tolist())
            for got in (many, C.repair_long(one)):
                made = [(int(r) if r >= 0 else None, {0: None, 1: "u", 2: "a"}[int(m)]) for x, y in zip(got.rows, got.made) for r, m in zip(x, y)]
                assert (got.cost, b"".join(got.audit).decode(), made) == (cost, audit, rows)


def test_ranks_are_those_of_whole_paths():
    rng = random.Random(5)
    target, first = np.arange(400), np.zeros(400, np.int64)
    for v in range(390):
        target[v], first[v] = rng.randint(v + 1, 399), rng.randint(1, 2)
    paths = []
    for v in range(400):
        word = ""
        while target[v] != v:
            word, v = word + str(first[v]), target[v]
        paths.append(word)
    rank, _ = C.rank_nodes(first, target)
    order = {p: i for i, p in enumerate(sorted(set(paths)))}
    assert rank.tolist() == [order[p] for p in paths]


def test_repair_of_odd_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 5, "assistant", "no end"), (2, None, "system", "Be."), (2, None, None, None), (2, 3, "", "x."),
            (None, 0, "user", "A."), (None, 2, "assistant", "B!"), (3, 0, "user", " \t\n"), (4, 0, "robot", "é" * 70_000 + ".")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash")).withColumn("seq", F.lit("clash"))
    reports, lines = C.repaired(table)
    got = {r.conv: r for r in reports.collect()}
    said = collections.defaultdict(list)
    for r in lines.orderBy("conv", "seq").collect():
        said[r.conv].append(r.line)
    assert got["=1"].audit == "KDK" and got["=1"].duplicate == 1 and got["=1"].truncated == 1 and got["=1"].gaps == 4 and got["=1"].cost == 4
    assert got[""].audit == "KK" and got[""].gaps == 1 and said[""] == ["user:A.", "assistant:B!"]
    assert got["=2"].blank == 1 and got["=2"].illegal == 2 and got["=2"].gaps == 0
    assert got["=3"].audit == "D" and got["=3"].blank == 1 and not said["=3"]
    assert got["=4"].audit == "D" and got["=4"].cost == 3
    assert C.repair_report(table.limit(0)).count() == 0
    gone = spark.createDataFrame([(i, 0, "user", "A.") for i in range(200)], "conv_id long, turn long, role string, text string")
    report = C.repair_report(gone).collect()
    assert len(report) == 200
    empty = [r for r in report if r.repaired_sha256 == hashlib.sha256(b"").hexdigest() and r.audit == ""]
    assert empty and all(r.cost == 0 and r.gaps == 0 for r in empty)


def test_one_long_conversation_is_repaired_in_blocks(spark, monkeypatch):
    rows = [(7, i, "user" if i % 3 else "assistant", f"turn {i}" + "." * (i % 5 > 0)) for i in range(300)] + [(8, i, "user", "again.") for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = rows_of(C.repair_report(table))
    monkeypatch.setattr(C, "BLOCK_ROWS", 16)
    assert rows_of(C.repair_report(table)) == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_plain_distances():
    rng = random.Random(6)
    words = {"".join(rng.choices("abc", k=rng.randint(2, 10))) for _ in range(25)}
    allowed = {w: toxicity.errors_allowed(len(w)) for w in words}
    stems = ["abca", "ccbb"]
    machine = toxicity.Automaton(toxicity.Lexicon(allowed, stems))
    for _ in range(3000):
        word = "".join(rng.choices("abcd", k=rng.randint(1, 12)))
        near = sorted(w for w, e in allowed.items() if 0 < distance(word, w) <= e)
        kind = toxicity.EXACT if word in words else toxicity.STEM if word.startswith(tuple(stems)) else toxicity.MISSPELLED if near else toxicity.NONE
        assert machine.kind(word) == kind, word
        assert sorted(machine.meant(word)) == near


def test_context_tells_quotation_from_abuse():
    kinds = toxicity._Kinds(toxicity.Automaton(toxicity.Lexicon({"idiot": 1}, [])))
    plain, address, report, quote = (toxicity.sums_of(t, kinds) for t in ("what an idiot", "you idiot", "he said idiot", 'he wrote "an idiot" here'))
    assert address[1] > plain[1] > report[1] > 0 and quote[1] == 0 < quote[3]
    assert toxicity.sums_of("idi0t", kinds)[1] == pytest.approx(math.log1p(toxicity.MISSPELLED_SHARE))
    assert toxicity.sums_of(None, kinds) == toxicity.sums_of("", kinds) == [1.0, 0.0, 0.0, 0.0]
    assert toxicity.sums_of("İ idiot " * 2, kinds)[1] > 0


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    report = toxicity.toxicity_report(docs, labels)
    seen = report.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in seen}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0]
    assert report.count() == docs.count()


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (2, "you idiot"), (None, "you idiot"), (4, "x" * 200_000 + " idiot " * 2000)], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    none = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity_report(docs, none).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows] == [0, 0, 1, 1, 1]
    assert toxicity.toxicity_report(docs.limit(0), none).count() == 0


def brute_archive(rows):
    """(page_id, copy, start, length, sha256) by sorting each file's records."""
    files = collections.defaultdict(list)
    for i, record in rows:
        i = -1 if i is None else i
        files[int(i / fixity.SHARD)].append((i, hashlib.sha256(record).hexdigest(), len(record)))
    out = []
    for records in files.values():
        start, seen = 0, collections.Counter()
        for i, sha, length in sorted(records):
            seen[i] += 1
            out.append((i, seen[i], start, length, sha))
            start += length
    return sorted(out)


def test_leaves_of_ids_with_very_many_records(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(rng.choice([None, None, 7, 7, 7, 8, 3000, -2000]), bytes(rng.choices(range(65, 70), k=rng.choice([1, 1, 2, 40])))) for _ in range(900)]
    table = spark.createDataFrame(rows, "page_id long, record binary")
    assert sorted(tuple(r) for r in fixity.leaves(table).collect()) == brute_archive(rows)
    monkeypatch.setattr(fixity, "FANOUT", 4)
    lost = list(rows)
    at = next(i for i, (p, r) in enumerate(rows) if p == 7 and len(r) == 40)
    lost[at] = (7, b"*" + rows[at][1][1:])
    other = spark.createDataFrame(lost, "page_id long, record binary")
    assert fixity.audit(table, table.repartition(5)).count() == 0
    want, got = ({(p, c): (s, h) for p, c, s, _, h in brute_archive(x)} for x in (rows, lost))
    found = {(r.page_id, r["copy"]): r for r in fixity.audit(table, other).collect()}
    assert set(found) == {k for k in want if want[k][1] != got[k][1]}
    fewer = spark.createDataFrame([r for r in rows if r[0] != 7 or len(r[1]) < 40], "page_id long, record binary")
    assert {r.kind for r in fixity.audit(table, fewer).collect()} <= {"missing", "changed"}
    grown = spark.createDataFrame([*rows, *[(8, b"new")] * 40], "page_id long, record binary")
    assert {r.page_id for r in fixity.audit(table, grown).collect()} == {8}
