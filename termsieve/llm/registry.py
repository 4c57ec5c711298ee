"""The registered queries of this subpackage, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termsieve.llm import exact_dedup, langid, licenses, line_dedup, minhash, mixing, packing, rp_forest, sharding, toxicity
from termsieve.llm.runtime import fleeting, scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the lines that are boilerplate on their host; see line_dedup.without_boilerplate()."""
    return line_dedup.without_boilerplate(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; see langid.identified()."""
    return langid.identified(_documents(spark, sf_dir))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents; see minhash.near_duplicates()."""
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near vectors among all embeddings; see rp_forest.near_vectors()."""
    return rp_forest.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents; see licenses.scanned()."""
    return licenses.scanned(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, with its nearest examples; see toxicity.scored()."""
    return toxicity.scored(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all documents; see exact_dedup.exact_duplicates()."""
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, arrived in batches and read back from compacted shards; see sharding.sharded()."""
    path = scratch_path(spark, "shards")
    out = sharding.sharded(_documents(spark, sf_dir), path)
    fleeting(spark, path)
    return out


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix to target weights takes of every document; see mixing.mixed()."""
    return mixing.mixed(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences, a row per piece, with a checksum for its ids; see packing.packed()."""
    return packing.digest(packing.packed(_documents(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_line_dedup, op2_language_id, op3_minhash_near_dedup, op4_embedding_near_dedup, op5_license_scan,
        op6_toxicity, op7_exact_dedup, op8_sharding, op9_source_mixing, op10_packing,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL, "op7_exact_dedup": exact_dedup.ORACLE_SQL}
