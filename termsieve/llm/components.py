"""Connected components over a distributed edge table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm.runtime import discard, stored

_TURN = 0x5DEECE66D


def agg_by(df: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """groupBy(key).agg(...) whose result a later join on `key` shuffles afresh.

    Spark splits skewed partitions only of joins with a plain exchange on both sides; grouping by a bijection
    of the key keeps the aggregate's own partitioning from being reused in its place.
    """
    turned = df.groupBy(F.col(key).bitwiseXOR(F.lit(_TURN)).alias("_turned")).agg(*aggs)
    return turned.withColumn(key, F.col("_turned").bitwiseXOR(F.lit(_TURN))).drop("_turned")


def connected_components(edges: DataFrame, ends: Sequence[str] = ("a", "b")) -> DataFrame:
    """(id, component): for every id in an edge the smallest id reachable from it, itself included.

    Alternating large-star and small-star steps (Kiveris et al. 2014) until the edge table no longer changes.
    Every step is a partially aggregated minimum and an equi-join, so a node with very many edges is split by
    adaptive execution; each round is written to the shared folder. Rows with a null end and loops are ignored;
    repeated edges count once; no edges give an empty table.
    """
    spark = edges.sparkSession
    a, b = (F.col(c).cast("long") for c in ends)
    now = stored(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "edges")
    mark = None
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v"), F.col("u")))
        low = agg_by(both, "x", F.min("y").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("v"), F.least("x", "m").alias("u")).distinct()
        large = stored(large, "large-star")
        low = agg_by(large, "v", F.min("u").alias("m"))
        small = large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(low.select("v", F.col("m").alias("u")))
        after = stored(small.select("u", "v").distinct(), "edges")
        seen = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        discard(spark, [now, large])
        now = after
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("id"), F.col("u").alias("component")).union(roots)
