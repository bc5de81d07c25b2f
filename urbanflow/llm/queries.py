"""The corpus operators applied to the driver tables, and the SQL that states the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm import bpe, conversations, decontaminate, lexical, transducer
from urbanflow.llm.backoff import scores
from urbanflow.llm.fixity import archive, audit
from urbanflow.llm.licenses import license_lines, license_sql
from urbanflow.llm.neardup import component_report
from urbanflow.llm.personal import personal_report
from urbanflow.llm.quality import quality_report
from urbanflow.llm.repeats import removal_report
from urbanflow.llm.texts import table
from urbanflow.llm.toxicity import toxicity_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


@query
def op10_weak_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_report(table(spark, sf_dir, "documents"))


@query
def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_lines(table(spark, sf_dir, "documents"))


ORACLES["op9_license_dice"] = license_sql()


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of the pages in which fixed ids lost a record, gained a byte, or got another address."""
    rest = F.col("page_id") % 101
    url = F.when(rest == 17, F.concat("url", F.lit("?"))).otherwise(F.col("url"))
    html = F.when(rest == 29, F.overlay("html", F.lit("*"), 1, 1)).otherwise(F.col("html"))
    return pages.where((rest != 53) | rest.isNull()).select("page_id", url.alias("url"), html.alias("html"))


@query
def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages against a damaged replica; SQL states the damage directly, without trees."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(archive(pages), archive(damaged(pages)))


_RECORD = """concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Target-URI: ', {u},
    chr(13), chr(10), 'WARC-Payload-Digest: sha256:', sha256({h}), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10),
    'Content-Length: ', strlen({h}), chr(13), chr(10), chr(13), chr(10), {h}, chr(13), chr(10), chr(13), chr(10))"""
ORACLES["op2_merkle_fixity"] = f"""
    WITH records AS (
      SELECT page_id, page_id % 101 AS rest, {_RECORD.format(u="url", h="html")} AS good,
             CASE WHEN page_id % 101 = 17 THEN {_RECORD.format(u="concat(url, '?')", h="html")}
                  WHEN page_id % 101 = 29 THEN {_RECORD.format(u="url", h="concat('*', html[2:])")} END AS bad
      FROM pages),
    placed AS (
      SELECT *, CAST(floor(page_id / 1024) AS BIGINT) AS file,
             CAST(coalesce(sum(strlen(good)) OVER (PARTITION BY page_id // 1024 ORDER BY page_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM records)
    SELECT page_id, 1 AS "copy", file, start, strlen(good) AS length, sha256(good) AS expected, sha256(bad) AS actual,
           CASE rest WHEN 53 THEN 'missing' ELSE 'changed' END AS kind
    FROM placed WHERE rest IN (17, 29, 53)"""


@query
def op3_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op3_wu_manber"] = decontaminate.ORACLE


@query
def op6_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_report(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op4_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_report(table(spark, sf_dir, "documents"), size=2, percent=80)


ORACLES["op4_min_max_hash"] = """
    WITH RECURSIVE lowered AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM lowered),
    items AS (SELECT doc_id, unnest(s) AS i FROM sets),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.i = b.i AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
    paired AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, paired.b FROM reach JOIN paired ON reach.b = paired.a),
    parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN parts ON a = doc_id"""


@query
def op5_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


@query
def op8_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


@query
def op11_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


ORACLES["op11_path_ranking"] = conversations.ORACLE


@query
def op12_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_norm_buckets"] = lexical.ORACLE
