"""A corpus from raw documents to packed sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import delete_folder, read_table, shared_folder, unused
from gridloom.llm.packing import pack_documents
from gridloom.llm.queries import vocabulary
from gridloom.llm.secrets import redact_secrets
from gridloom.llm.similar import drop_similar
from gridloom.llm.substrings import dedup_substrings
from gridloom.llm.toxicity import keep_benign


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the lexicon model rejects (score of 0.3 or more).

    The model is learned from the labels of documents that are not held out. Null and empty texts are
    scored like any other; repeated rows are kept or dropped together; columns of any name come back unchanged.
    """
    return keep_benign(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group linked by a five-word-shingle similarity of 0.8 or more.

    Texts without words, null and empty ones among them, are one group. Rows without an id all stay; of
    repeated rows one stays; columns of any name come back unchanged.
    """
    return drop_similar(docs, width=5, least=0.8).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take passages out of a text that a document with a smaller id holds too; n_chars, if there, follows the text.

    Null and short texts, repeated rows and all other columns, whatever their names, come back unchanged.
    """
    spans, firsts = unused(docs, "removed_spans"), unused(docs, "first_doc_ids")
    cleaned = dedup_substrings(docs, spans_col=spans, firsts_col=firsts)
    return with_length(cleaned, F.size(spans) > 0).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; n_chars, if there, follows the text.

    Null texts stay null; repeated rows and all other columns, whatever their names, come back unchanged.
    """
    old = unused(docs, "old_text")
    redacted = redact_secrets(docs.withColumn(old, F.col("text")))
    return with_length(redacted, ~F.col("text").eqNullSafe(F.col(old))).select(*docs.columns)


def with_length(docs: DataFrame, changed: Column) -> DataFrame:
    """docs with n_chars set to the text's length where it changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 1024 tokens.

    One row for each piece of a document, as pack_documents gives them; null texts count as empty,
    repeated rows are packed as often as they occur, other columns are not returned.
    """
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express a learned lexicon, a vocabulary's merges or a rolling hash; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared checkpoint folder and read again.

    A stage's table is deleted when the next one stands; the last is read by the result.
    """
    root = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return result
        path = f"{root}/{i}-{name}"
        result.write.parquet(path)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
