"""The corpus operators against brute force, and on NULLs, empty and odd texts, repeated rows and empty tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import string
import struct
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.check_oracle import differences, duck
from urbanflow.llm import backoff, blocks, bpe, components, decontaminate, fixity, licenses, neardup, personal, quality, queries, repeats, transducer

SF = "/root/testdata/sf0.001"
BLANKS = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def corpus(spark):
    """The smallest documents with odd ones, a clashing extra column, and a repeated row."""
    odd = [None, "", " \n\t", "a", "A a", "x" * 300, "ab " * 3000, "é" * 70 + " 😀 <|endoftext|> a@b.co 1.2.3.4 " * 3,
           "card 4111 1111 1111 1111, +1 (222) 333-4444 or 256.1.1.1", 'token = "24be64439e3e49c24be64439e3e49c24be64439e"', "a"]
    rows = [(100_000 + min(i, 9), t, None, None, 0, "x") for i, t in enumerate(odd)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("n_words", F.lit("clash"))
    return docs.unionByName(extra)


@pytest.fixture(scope="module")
def texts(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def base_counts(text):
    text = text or ""
    words = re.findall(BLANKS, text)
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(BLANKS, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_verdicts(corpus, texts):
    report = quality.quality_report(corpus)
    got = rows_of(report.select("doc_id", *quality.COUNTS, "base_failed"))
    want = []
    for i, t in texts:
        c = base_counts(t)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert got == sorted(want, key=str)
    assert report.where("base_failed AND kept").count() == 0


def test_quality_rejects_planted_outliers_only(spark):
    rng = random.Random(3)
    clean = [" ".join(rng.choice(["house", "tree", "river", "of", "the", "stone"]) + str(rng.randint(0, 999)) for _ in range(rng.randint(60, 300))) for _ in range(200)]
    junk = [" ".join(w + "###$$$" for w in t.split()) for t in clean[:6]]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string, source string")
    gone = {r.doc_id for r in quality.quality_report(docs).where("NOT kept").collect()}
    assert gone == set(range(200, 206))
    kept = quality.keep_good(docs.withColumn("_g", F.lit(1)))
    assert kept.columns == [*docs.columns, "_g"] and kept.count() == 200


def test_quality_of_small_groups_leans_on_their_language(spark):
    """An estimate moves smoothly from the language's to the group's own as the group grows; no size is a switch."""
    rng = random.Random(9)

    def text(words):
        return " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(rng.randint(60, 300)))

    texts = [text(["internationalisation", "responsibilities"]) for _ in range(200)]
    large = [(1000 + i, text(["house", "tree", "of"]), "en", "large") for i in range(400)]

    def distances(n):
        rows = [(i, t, "en", "small") for i, t in enumerate(texts[:n])] + large
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return [r.distance for r in quality.quality_report(docs).where("doc_id < 3").orderBy("doc_id").collect()]

    few, less, more, many = (sum(distances(n)) for n in (4, 39, 41, 200))
    assert few > 2 * less and less == pytest.approx(more, rel=0.15) and many < more


def brute_densest(points, share):
    """The least logarithm of the root of the determinant over all subsets of a share of the points."""
    size = math.ceil(share * len(points))
    floors = np.diag(np.square(quality.FLOORS))
    factor = quality._consistency(share) if share < 1 else 1.0
    found = []
    for chosen in itertools.combinations(range(len(points)), size):
        own = points[list(chosen)]
        found.append(0.5 * np.linalg.slogdet(np.cov(own.T, bias=True) * factor + floors)[1])  # of the root
    return min(found)


def test_concentration_finds_the_densest_subset(spark):
    rng = np.random.default_rng(5)
    groups = {}
    for g in range(12):
        points = rng.normal(size=(12, 4)) * (1 + g % 3)
        points[: g % 4] += rng.choice([-1, 1], 4) * 12  # up to a quarter far off
        groups[str(g)] = points
    rows = [(g, *map(float, p)) for g, points in groups.items() for p in points]
    table = spark.createDataFrame(rows, "g string, x0 double, x1 double, x2 double, x3 double")
    found = {r.g: r.best for r in quality.concentrated(table).groupBy("g").agg(F.min("logdet").alias("best")).collect()}
    least = {g: brute_densest(points, quality.DENSEST) for g, points in groups.items()}
    assert all(found[g] >= least[g] - 1e-6 for g in groups)
    # With as many far points as are left out, it is the least of all subsets; without, a subset that no step makes denser.
    assert all(found[g] == pytest.approx(least[g], abs=1e-6) for g in ("3", "7", "11"))
    everything = {g: brute_densest(points, 1) for g, points in groups.items()}
    assert all(found[g] < everything[g] + math.log(quality._consistency(quality.DENSEST)) * 2 for g in groups)


def test_fixity_equal_replicas_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (None, None, None), (5000, "v", "")], "page_id long, url string, html string")
    assert fixity.audit(fixity.archive(pages), fixity.archive(pages)).count() == 0
    assert fixity.audit(fixity.archive(pages.limit(0)), fixity.archive(pages.limit(0))).count() == 0
    lost = fixity.audit(fixity.archive(pages), fixity.archive(pages.where("page_id = 1")))
    assert sorted((r.page_id, r.kind) for r in lost.collect()) == [(-1, "missing"), (5000, "missing")]


def test_wu_manber_equals_plain_search(spark, corpus, texts):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 3, 12, 30])))) for i in range(30)]
    items += [(99, None), (100, "ab ab AB ab ab ab ab ab ab ab")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = spark.createDataFrame([(7000 + i, " ".join(rng.choice("abc") for _ in range(60))) for i in range(40)], "doc_id long, text string")
    docs = corpus.select("doc_id", "text").unionByName(more)
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = pattern.findall(lowered(t))
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    want = []
    for i, t in ((r.doc_id, r.text) for r in docs.collect()):
        w, hit, ids = pattern.findall(lowered(t)), set(), set()
        for k in range(len(w)):
            for size in range(1, 11):
                found = windows.get(tuple(w[k : k + size]))
                if found and k + size <= len(w):
                    hit.update(range(k, k + size))
                    ids |= found
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    assert rows_of(decontaminate.contamination_report(docs, bench)) == sorted(want, key=str)
    assert decontaminate.drop_contaminated(corpus, bench.limit(0)).columns == corpus.columns


def test_wu_manber_holds_one_chunk_at_a_time(spark, corpus, monkeypatch):
    rng = random.Random(8)
    docs = corpus.select("doc_id", "text").unionByName(
        spark.createDataFrame([(7000 + i, " ".join(rng.choices("abc", k=60))) for i in range(40)], "doc_id long, text string"))
    bench = spark.createDataFrame([(i, " ".join(rng.choices("abc", k=4 + i))) for i in range(9)], "item_id long, text string")
    want = rows_of(decontaminate.contamination_report(docs, bench))
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 40)
    chunks = list(decontaminate._chunks(bench))
    assert len(chunks) >= 3 and sum(map(len, chunks)) == 9
    report = decontaminate.contamination_report(docs, bench)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert rows_of(report) == want and any(r[-1] for r in want)
    assert decontaminate.drop_contaminated(docs, bench).count() == sum(not r[-1] for r in want)


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts:
        w = re.findall(BLANKS, lowered(t))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                p, q = sorted((top(a), top(b)))
                label[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(60)] for _ in range(6)]
    texts = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "two words")]
    for i in range(150):
        words = list(base[i % 6])
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(60)] = f"v{rng.randint(0, 5)}"
        texts.append((10 + i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n", F.lit("clash"))
    want = brute_components(texts, 2, 80)
    for wide in (512, 3):
        monkeypatch.setattr(neardup, "WIDE", wide)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.component_report(docs, 2, 80).collect()}
        assert got == want
    assert neardup.keep_one_of_each(docs, 2, 80).count() == len({c for _, c in want.values()})
    assert neardup.component_report(docs.limit(0), 2, 80).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in components.components(edges).collect()} == {0}


def test_backoff_scores_equal_counting(corpus, texts, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(blocks, "PART_BYTES", 150_000)
    for order in (2, 3):
        counts = [collections.Counter() for _ in range(order + 1)]
        marked = [(i, ["<begin>", *[("w", w) for w in re.findall(BLANKS, lowered(t))], "<end>"]) for i, t in texts]
        for i, s in marked:
            if zlib.crc32(str(i).encode()) % 7 != 2:
                for k in range(1, order + 1):
                    counts[k].update(tuple(s[j : j + k]) for j in range(len(s) - k + 1))
        begins = counts[1].get(("<begin>",), 0)
        tokens, types = sum(counts[1].values()) - begins, len(counts[1]) - bool(begins)

        def p(h, w):
            if not h:
                return (counts[1][(w,)] + 1) / (tokens + types + 1)
            return (counts[len(h) + 1][(*h, w)] + backoff.PRIOR * p(h[1:], w)) / (counts[len(h)][h] + backoff.PRIOR)

        got = collections.defaultdict(list)
        for r in backoff.scores(corpus, order).collect():
            got[r.doc_id].append(r)
        for i, s in marked:
            score = sum(math.log10(p(tuple(s[max(0, j - order + 1) : j]), s[j])) for j in range(1, len(s)))
            base = sum(math.log10(p((), w)) for w in s[1:])
            r = got[i][0]
            assert (r.n_tokens, r.train_tokens) == (len(s) - 1, tokens) or len(got[i]) > 1
            assert len(got[i]) > 1 or (abs(r.score - score) < 1e-6 * abs(score) and abs(r.base_score - base) < 1e-6 * abs(base))


def test_backoff_beats_unigrams_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = backoff.scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_backoff_query_has_histories_of_two_words(spark):
    got = {tuple(r) for r in queries.op5_backoff_scores(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got == {tuple(r) for r in backoff.scores(docs, 3).collect()} != {tuple(r) for r in backoff.scores(docs, 2).collect()}


def test_transducer_counts_equal_the_library(corpus, texts, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts}
    assert {r.doc_id: r.n_tokens for r in transducer.count_report(corpus, path).collect()} == want
    monkeypatch.setattr(transducer, "CHUNK", 7)
    machine = transducer.Transducer(transducer.Vocabulary(open(path, encoding="utf-8").read()))
    rng = random.Random(4)
    bits = ["a", "b", " ", "  ", "\n", "'s", "é", "中", "12", "!", "<|endoftext|>", "<|endof", "😀", "\xa0", "ing", "the"]
    for _ in range(500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_tree_bpe_equals_the_library(corpus, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows_of(bpe.token_report(corpus, path, public_tokenizers.PATTERN)) == sorted(want, key=str)
    coder = bpe.TreeBpe(ranks, public_tokenizers.PATTERN)
    rng = random.Random(5)
    for text in ["a" * 20_000, "ab" * 5000, *["".join(rng.choice("abc") for _ in range(300)) for _ in range(100)]]:
        ids = library.encode_ordinary(text)
        assert coder.encode(text) == struct.pack(f"<{len(ids)}I", *ids) and coder.decode(ids, 64) == text.encode()


def brute_removal(texts, length=50):
    owner = {}
    for i, t in texts:
        b = (t or "").encode()
        for j in range(len(b) - length + 1):
            owner[b[j : j + length]] = min(owner.get(b[j : j + length], i), i)
    for i, t in texts:
        b, gone = (t or "").encode(), set()
        for j in range(len(b) - length + 1):
            if owner[b[j : j + length]] < i:
                gone.update(range(j, j + length))
        runs = sum(1 for k in gone if k - 1 not in gone)
        yield i, len(b), len(gone), runs, hashlib.sha256(bytes(x for k, x in enumerate(b) if k not in gone)).hexdigest()


@pytest.mark.parametrize("crowd", [4096, 3])
def test_interval_expansion_equals_all_strings(spark, texts, monkeypatch, crowd):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcd é") for _ in range(200)) for _ in range(8)]
    more = [(9000 + i, "".join(rng.choice(base)[rng.randint(0, 90) :][: rng.randint(40, 120)] for _ in range(rng.randint(0, 5)))) for i in range(150)]
    more += [(8000, "x" * 400), (8001, "x" * 49), (8002, "\0" * 120), (8003, "\0" * 60 + "y" * 60)]
    rows = texts[:100] + more
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(blocks, "PART_BYTES", 50_000)
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(repeats.removal_report(docs)) == sorted(brute_removal(rows), key=str)
    assert repeats.removal_report(docs.limit(0)).count() == 0


def shared_passages(seed=8, texts=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(6)]
    return [(i, "".join(rng.choice(base)[rng.randint(0, 150) :][: rng.randint(60, 140)] for _ in range(rng.randint(0, 6)))) for i in range(texts)]


def removed_in_blocks(rows, parts, crowd, length=50):
    """What the steps of op8 remove, run on tables here."""
    zipped = lambda t: len(t).to_bytes(8, "little") + pa.compress(t.encode(), "zstd", asbytes=True)
    tables = [pa.table({"doc_id": [i for i, _ in r], "text": [zipped(t) for _, t in r], "block": [b] * len(r)}) for b, r in enumerate(rows)]
    by = lambda t, c, n: [t.filter(pc.equal(t[c], k)) for k in range(n)]
    asked = pa.concat_tables([repeats.anchors_asked(t, length, parts) for t in tables])
    totals = pa.concat_tables([repeats.anchors_answered(t, crowd) for t in by(asked, "part", parts) if len(t)])
    sent = pa.concat_tables([repeats.fragments_asked(t, a, length, parts, crowd) for t, a in zip(tables, by(totals, "block", len(rows)))])
    owned = pa.concat_tables([repeats.fragments_answered(t, length) for t in by(sent, "part", parts) if len(t)])
    answers = pa.concat_tables([totals, owned], promote_options="default")
    out = [repeats.removed_bytes(t, a, length, parts, crowd) for t, a in zip(tables, by(answers, "block", len(rows)))]
    return asked, {i: (s, e) for t in out for i, s, e in zip(*(t[c].to_pylist() for c in ("doc_id", "starts", "ends")))}


def runs_by_brute_force(texts, length=50):
    owner, runs = {}, {}
    for i, t in texts:
        for j in range(len(t) - length + 1):
            owner[t[j : j + length]] = min(owner.get(t[j : j + length], i), i)
    for i, t in texts:
        gone = sorted({k for j in range(len(t) - length + 1) if owner[t[j : j + length]] < i for k in range(j, j + length)})
        runs[i] = [k for k in gone if k - 1 not in set(gone)], [k + 1 for k in gone if k + 1 not in set(gone)]
    return runs


@pytest.mark.parametrize("crowd", [4096, 5, 0])
@pytest.mark.parametrize("hashes", ["own", "equal"])
def test_interval_expansion_by_steps(monkeypatch, crowd, hashes):
    """In several lots, with crowded anchors, and with contents that have the hash of another one."""
    texts = shared_passages() + [(500, "z" * 200), (501, "z" * 120), (502, ""), (503, "q" * 49)]
    rows = [texts[k::4] for k in range(4)]
    monkeypatch.setattr(repeats, "SEARCH_BYTES", 2000)
    monkeypatch.setattr(repeats, "RUN_BYTES", 500)
    if hashes == "equal":
        monkeypatch.setattr(repeats, "_mixed", lambda x: np.zeros(len(x), np.uint64))
        data = repeats.Bytes(b"a" * 60 + b"b" * 60 + b"a" * 60 + b"b" * 60 + b"a" * 59 + b"c")
        digest, first, number = data.distinct(np.arange(5) * 60, np.array([60, 55, 60, 55, 60]), 50)
        assert first.tolist() == [0, 1, 4] and number.tolist() == [0, 1, 0, 1, 2] and not digest.any()
    assert removed_in_blocks(rows, 3, crowd)[1] == runs_by_brute_force(texts)


def test_interval_expansion_asks_and_searches_in_small_pieces(monkeypatch):
    """What a part searches at once does not grow with the part, single strings that differ are not searched, and an
    anchor is asked for in four bytes."""
    texts = shared_passages(texts=400)
    rows = [texts[k::4] for k in range(4)]
    sizes, borders = [], repeats.prefix_borders
    monkeypatch.setattr(repeats, "prefix_borders", lambda t, depth: sizes.append(len(t)) or borders(t, depth))
    monkeypatch.setattr(repeats, "SEARCH_BYTES", 2000)
    asked, few = removed_in_blocks(rows, 2, 4096)
    assert sum(map(len, asked["keys"].to_pylist())) == 4 * sum(len(c) for c in asked["counts"].to_pylist())
    assert len(sizes) > 3 and max(sizes) < sum(sizes) / 3
    sizes.clear()
    _, single = removed_in_blocks(rows, 2, 0)
    assert few == single == runs_by_brute_force(texts) and not sizes


def test_license_pruning_loses_nothing():
    for text in licenses.TEMPLATES.values():
        form = licenses.bigrams_of(text)
        words = licenses.telling_words(form, licenses.THRESHOLD)
        assert len([b for b in form if not set(b.split()) & set(words)]) < licenses.least_overlap(len(form), licenses.THRESHOLD)


def brute_licenses(text):
    """Every window of every size that a template admits, and every whole line, without pruning; best ones first."""
    lines = [re.findall("[a-z0-9]+", x) for x in text.lower().split("\n")]
    words, at = [w for x in lines for w in x], [i for i, x in enumerate(lines) for _ in x]
    grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = set()
    for name, notice in licenses.TEMPLATES.items():
        form = set(licenses.bigrams_of(notice))
        spans = {(i, j) for i in range(len(grams)) for j in range(i, min(len(grams), i + licenses.longest_window(notice, 0.8)))}
        spans |= {(at.index(k), at.index(k) + len(x) - 2) for k, x in enumerate(lines) if len(x) >= 2}
        for i, j in spans:
            seen = set(grams[i : j + 1])
            dice = 2 * len(seen & form) / (len(seen) + len(form))
            if dice >= 0.8:
                found.add((len(seen) + len(form) - 3 * len(seen & form), -dice, name, j - i, i))
    chosen = []
    for x in sorted(found):
        if all(x[4] + x[3] + 1 < c[4] or c[4] + c[3] + 1 < x[4] for c in chosen):
            chosen.append(x)
    return {(at[i], name, -loss) for _, loss, name, _, i in chosen}


def test_wrapped_and_embedded_notices(spark):
    rng, t = random.Random(7), licenses.TEMPLATES
    texts = ["\n".join(["intro words", *textwrap.wrap(x, 40, initial_indent="# ", subsequent_indent="# "), "end"]) for x in t.values()]
    texts += [f"Some words of mine come first, then this: {x} And a good many other words follow on the same line." for x in t.values()]
    texts += [f"{t['MIT']} And {t['Apache-2.0']} {t['MIT']}", "the mit license " * 30 + "released under the", "Released under the MIT License. " * 6]
    for _ in range(40):
        words = " ".join(rng.choices(list(t.values()), k=2)).split()
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = rng.choice(["", "the", "other", "License,\nthe"])
        texts.append("\n".join(textwrap.wrap(" ".join(words), rng.choice([30, 78, 500]))))
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, "license")], "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in licenses.license_lines(docs).collect():
        got[r.doc_id].add((r.line, r.license, r.dice))
    for i, text in enumerate(texts):
        assert got[i] == brute_licenses(text), text
    assert all(name in {x[1] for x in got[i]} for i, name in enumerate([*t, *t]))
    assert not got[900] and not got[901]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, digits[::-1])))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_personal_base_spans_equal_regular_expressions(corpus, texts):
    got = {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in personal.personal_report(corpus).collect()}
    want = set()
    for i, t in texts:
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if valid(k, m[0])] for k, p in PATTERNS.items()}
        listed = ",".join(x for found in spans.values() for x in found)
        want.add((i, hashlib.sha256(listed.encode()).hexdigest(), *map(len, spans.values())))
    assert got == want


def test_personal_masks_and_adds_keys(spark):
    rows = [(i, f'call me at +1 (222) 333-44{i:02d} token = "{hashlib.sha1(bytes([i])).hexdigest()}" on page 12345678') for i in range(60)]
    docs = spark.createDataFrame([*rows, (90, None)], "doc_id long, text string")
    masked = {r.doc_id: r.text for r in personal.mask_personal(docs).collect()}
    assert masked[90] is None
    assert all("<phone>" in masked[i] and '"<key>"' in masked[i] and "12345678" in masked[i] for i in range(60))


def planted(rng):
    """(text, personal spans): as many ordinary numbers and names stand in it as personal ones."""

    def some(of, k):
        return "".join(rng.choices(of, k=k))

    digits, signs = string.digits, string.ascii_letters + string.digits
    personal_ones = [
        ("call ", f"({some(digits, 3)}) {some(digits, 3)}-{some(digits, 4)}", " today"), ("my ssn ", f"{some(digits, 3)}-{some(digits, 2)}-{some(digits, 4)}", "."),
        ('token = "', hashlib.sha1(some(signs, 9).encode()).hexdigest(), '"'), ("key: ", "AKIA" + some(string.ascii_uppercase + digits, 15) + "7", " end"),
        ('password "', "ghp_" + some(signs, 34) + "a1", '"'), ("phone ", f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}", ","),
    ]
    others = [
        ("page ", "0" + some(digits, 6), ""), ("on line ", some(digits, 7), ""), ("version ", "0" + some(digits, 7), " of"),
        ("about $", some(digits, 7), " or"), ("the name ", "variable_name_of_part" + some(digits, 1), " there"), ("figure ", some(digits, 7), "."),
    ]
    text, spans = "Some prose goes before. ", []
    for _ in range(4):
        own = rng.random() < 0.5
        before, middle, after = rng.choice(personal_ones if own else others)
        text += before
        spans += [(len(text), len(text) + len(middle))] if own else []
        text += middle + after + " and more words follow. "
    return text, spans


def test_added_spans_have_precision_and_recall(spark):
    rng = random.Random(12)
    rows = [planted(rng) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x] for r in personal.personal_report(docs).collect()}

    def met(span, spans):
        return any(span[0] < b and a < span[1] for a, b in spans)

    wanted = [met(s, got[i]) for i, (_, spans) in enumerate(rows) for s in spans]
    said = [met(s, rows[i][1]) for i, spans in got.items() for s in spans]
    assert sum(wanted) >= 0.9 * len(wanted) and sum(said) >= 0.9 * len(said) and len(wanted) > 700


def test_votes_find_the_reliable_labelers():
    counts = {(1, 1, 1, 0, 0): 50, (-1, -1, -1, 0, 0): 50, (1, 1, -1, 0, 0): 5, (-1, -1, 1, 0, 0): 5}
    posterior, rates = personal.aggregate_votes(counts)
    assert posterior[1, 1, -1, 0, 0] > 0.9 > 0.1 > posterior[-1, -1, 1, 0, 0]
    assert rates[0][1][1] > rates[2][1][1]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert differences(got, duck(SF).sql(queries.ORACLES[name]).df()) is None


def test_pipeline_keeps_clean_documents_once(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids))
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    single = {i for i, (_, c) in brute_components(texts, 5, 80).items() if i == c}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contamination_report(docs, bench).where("contaminated").collect()}
    assert set(ids) == single - leaks


def test_keys_of_ngrams_are_coded_below_their_eight_bytes():
    """Keys of a block and what is told of them survive their coding; before, a key took eight bytes and its count one or two."""
    draws = np.random.default_rng(5)
    keys = np.unique(draws.integers(0, 2**64, 400_000, np.uint64))
    keys[0], keys[-1] = 0, 2**64 - 1
    counts = draws.geometric(0.7, len(keys)) - 1
    counts[7] = 70_000
    taken, back = 0, []
    for part, places in backoff.by_range(keys, 9):
        taken += len(backoff.coded(keys[places])) + len(backoff.coded_counts(counts[places]))
        back.append((backoff.decoded(backoff.coded(keys[places])), part))
        assert np.array_equal(backoff.decoded_counts(backoff.coded_counts(counts[places]), places.stop - places.start), counts[places])
    assert np.array_equal(np.concatenate([k for k, _ in back]), keys) and [p for _, p in back] == list(range(9))
    assert taken < 6.6 * len(keys)
    for some in (keys[:1], keys[-1:]):
        assert np.array_equal(backoff.decoded(backoff.coded(some)), some)


def test_packed_texts_come_back(spark):
    """Before, blocks were sent with plain texts."""
    texts = [None, "", "é漢 \n", "word " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = backoff.zipped(docs).toArrow().sort_by("doc_id")
    assert backoff.unzipped(found["text"]) == texts and len(found["text"][3].as_py()) < 1000
