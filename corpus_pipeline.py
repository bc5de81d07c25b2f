"""From raw documents to tokens: five stages over the table `documents`, each written as Parquet before the next.

Every stage takes an empty table, and columns of any name besides those of documents. A text that is NULL or empty fails
the base rules and goes in the first stage; by itself, each later stage keeps it: it has no shingles, no words of a
benchmark, no spans and no tokens. Rows that share an id are one document to near-duplicate search and rows of their own
elsewhere; of equal documents with different ids, the smallest id stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm.bpe import encoded
from urbanflow.llm.decontaminate import drop_contaminated
from urbanflow.llm.neardup import keep_one_of_each
from urbanflow.llm.personal import mask_personal
from urbanflow.llm.quality import keep_good
from urbanflow.llm.texts import table
from urbanflow.session import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by five-word shingles at a similarity of 0.8, the document of the smallest id stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal spans of the texts are replaced by their kinds."""
    return mask_personal(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256): the tokens as little-endian 32-bit integers."""
    coded = encoded(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    n = (F.octet_length("_ids") / 4).cast("bigint")
    return coded.select(
        "doc_id", "lang", "source", n.alias("n_tokens"), F.col("_ids").alias("ids"),
        F.sha2("_ids", 256).alias("ids_sha256"), F.sha2("_decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
# SQL cannot state the concentration steps, the classifier or the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
