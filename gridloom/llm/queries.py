"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_in_partitions
from .bpe import encode_documents
from .common import read_table
from .language import identify_languages
from .lines import quality_rules
from .negatives import hard_negatives
from .packing import pack_documents
from .secrets import KINDS, with_secrets, written
from .sharding import shard_rows
from .simhash import near_duplicate_components
from .substrings import dedup_substrings
from .topk import exact_top_k
from .toxicity import classify_toxicity
from .whitening import whiten


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; a parameter everywhere else."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_randomness_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("_base", lambda s: s["kind"])
    number = [F.size(F.filter(kinds, lambda kind: kind == F.lit(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *number, F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def op2_fuzzy_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify_toxicity(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))


def op3_bpe_word_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), with_ids=False)


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_dual_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cleaned.select("doc_id", "text", removed.alias("removed_chars"), "removed_spans", "first_doc_ids")


def op9_learned_partitions_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_in_partitions(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_randomised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_crf_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_rotated_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_randomness_secret_scan": op1_randomness_secret_scan,
        "op2_fuzzy_lexicon_toxicity": op2_fuzzy_lexicon_toxicity,
        "op3_bpe_word_ranks": op3_bpe_word_ranks,
        "op4_feistel_sharding": op4_feistel_sharding,
        "op5_simhash_near_dedup": op5_simhash_near_dedup,
        "op6_dual_cover_tree_top_k": op6_dual_cover_tree_top_k,
        "op7_cross_parsing_language": op7_cross_parsing_language,
        "op8_chunk_dedup": op8_chunk_dedup,
        "op9_learned_partitions_ann": op9_learned_partitions_ann,
        "op10_hierarchical_packing": op10_hierarchical_packing,
        "op11_randomised_whitening": op11_randomised_whitening,
        "op12_crf_line_quality": op12_crf_line_quality,
        "op13_rotated_hard_negatives": op13_rotated_hard_negatives,
    }


TOP_K_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


NEGATIVES_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
 n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """The exact searches are SQL queries; the others are tested against plain versions of their own."""
    return {"op6_dual_cover_tree_top_k": TOP_K_SQL, "op13_rotated_hard_negatives": NEGATIVES_SQL}
