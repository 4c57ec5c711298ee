"""A corpus pipeline over documents; every stage is one operator of termsieve.llm.

All stages but the last return the columns of their input, whatever these are called; an empty table gives an empty one.
Nulls may stand in any column, texts may be empty or very long, and rows may be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termsieve.llm import exact_dedup, minhash, mixing, packing, toxicity
from termsieve.llm.runtime import stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; labels come from the labels table.

    Each row is judged by its own text, repeated ones alike; null and empty texts have no term and stay, and so do all
    rows where there are no labels.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays, null being the least.

    Null and empty texts are equal. Of repeated rows one stays, the least by its other columns.
    """
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays.

    Null and empty texts have no copies; rows with a null id stay; rows that share an id are one document.
    """
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; a document comes once for each pass over it.

    Null is a source of its own; documents without words, and those that the mix does not reach, are left out. A pass
    that ends inside a document gives its first words.
    """
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, a row per piece of a document.

    Null and empty texts are documents of the end id alone; null ids and repeated rows are packed like others.
    """
    return packing.digest(packing.packed(docs))


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]

#: A k-nearest-neighbour score is not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
