"""Empty tables and clashing columns for every operator and every stage."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from urbanflow.llm import backoff, bpe, conversations, decontaminate, fixity, lexical, licenses, neardup, personal, quality, repeats, toxicity, transducer

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Names that operators use for columns of their own.
CLASHES = ["row", "_t", "_w", "stats", "g", "n", "block", "part", "bands", "node", "label", "line", "_spans", "_items", "_n_words", "_ids", "score", "held_out", "spans", "copy", "start", "h", "seq", "file"]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


OPERATORS = {
    "op1": ("documents", lambda d, s: quality.quality_report(d)),
    "op2": ("pages", lambda d, s: fixity.leaves(fixity.archive(d))),
    "op3": ("documents", lambda d, s: decontaminate.contamination_report(d, table(s, "benchmark"))),
    "op4": ("documents", lambda d, s: neardup.component_report(d, 2, 80)),
    "op5": ("documents", lambda d, s: backoff.scores(d).select("doc_id", "n_tokens", F.round("score", 6))),
    "op6": ("documents", lambda d, s: transducer.count_report(d, public_tokenizers.path("byte_bpe_50k.json"))),
    "op7": ("documents", lambda d, s: bpe.token_report(d, RANKS, public_tokenizers.PATTERN)),
    "op8": ("documents", lambda d, s: repeats.removal_report(d)),
    "op9": ("documents", lambda d, s: licenses.license_lines(d)),
    "op10": ("documents", lambda d, s: personal.personal_report(d)),
    "op11": ("conversations", lambda d, s: conversations.repair_report(d)),
    "op12": ("documents", lambda d, s: toxicity.toxicity_report(d, table(s, "labels"))),
    "op13": ("documents", lambda d, s: lexical.ranked(d, table(s, "benchmark"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows_and_clashing_columns_change_nothing(spark, name):
    source, operator = OPERATORS[name]
    plain = table(spark, source)
    clashing = plain.withColumns({c: F.lit("clash") for c in CLASHES if c not in plain.columns})
    assert operator(clashing.limit(0), spark).count() == 0
    few = plain.where("doc_id < 60") if source == "documents" else plain
    more = clashing.where("doc_id < 60") if source == "documents" else clashing
    want, got = (sorted(map(str, operator(x, spark).collect())) for x in (few, more))
    assert got == want and want


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_nulls_and_clashing_columns(spark, stage):
    docs = table(spark, "documents")
    clashing = docs.withColumns({c: F.lit("clash") for c in CLASHES})
    empty = stage(spark, clashing.limit(0), SF)
    assert empty.count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    rows = stage(spark, docs.where("doc_id < 40").unionByName(odd).withColumns({c: F.lit("clash") for c in CLASHES}), SF)
    if stage is corpus_pipeline.tokens:
        assert rows.count() == docs.where("doc_id < 40").count() + 3
    else:
        assert rows.columns == clashing.columns and all(r["row"] == "clash" for r in rows.collect())
