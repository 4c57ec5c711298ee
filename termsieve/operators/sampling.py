"""Reproducible samples: by hash, so that reruns and other partitionings give the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOTS = 65536


def lot(key: Column, seed: int = 1) -> Column:
    """A number from 0 to 65535 out of the MD5 of the seed and the key as text: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 4), 16, 10).cast("int")


def fraction(key: Column, seed: int = 1) -> Column:
    """A number of 52 bits from 0 to 1, exclusive, out of the same MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def share(rows: DataFrame, key_col: str, fraction: float, seed: int = 1) -> DataFrame:
    """About that fraction of the rows, each kept or left by its key alone."""
    return rows.where(lot(F.col(key_col), seed) < int(fraction * _LOTS))


def exact_share(rows: DataFrame, key_col: str, fraction: float, seed: int = 1) -> DataFrame:
    """round(fraction * rows) rows, halves to even, by lot."""
    return fixed(rows, key_col, round(fraction * rows.count()), seed)


def fixed(rows: DataFrame, key_col: str, n: int, seed: int = 1) -> DataFrame:
    """n rows by lot, all if there are fewer."""
    return rows.orderBy(lot(F.col(key_col), seed), key_col).limit(n)


def stratified(rows: DataFrame, stratum_col: str, key_col: str, n: int, seed: int = 1) -> DataFrame:
    """n rows of each stratum by lot, all of a stratum that is short. Spark cuts groups before the shuffle."""
    order = Window.partitionBy(stratum_col).orderBy(lot(F.col(key_col), seed), key_col)
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


@dataclass(frozen=True)
class Stratum:
    """An interval; its ends are open unless they are said to be closed."""

    name: str
    start: float
    end: float
    left: str = "open"
    right: str = "open"


def stratum(value: Column, strata: Sequence[Stratum]) -> Column:
    """The first stratum that holds the value; null if none does."""
    out = None
    for s in strata:
        fits = (value >= s.start if s.left == "closed" else value > s.start) & (value <= s.end if s.right == "closed" else value < s.end)
        out = F.when(fits, s.name) if out is None else out.when(fits, s.name)
    return out if out is not None else F.lit(None).cast("string")


def session(rows: DataFrame, session_col: str, order_col: str, seed: int = 1) -> DataFrame:
    """All rows of one session, chosen by lot, in order."""
    one = rows.select(session_col).distinct().orderBy(lot(F.col(session_col), seed), session_col).limit(1)
    return rows.join(F.broadcast(one), session_col, "left_semi").orderBy(order_col)  # one row


def weighted_draws(weights: DataFrame, name_col: str, weight_col: str, n: int, seed: int = 1) -> DataFrame:
    """n draws with replacement: (draw, name). Weights are a small distribution, laid out over the unit interval."""
    order = Window.orderBy(name_col).rowsBetween(Window.unboundedPreceding, 0)
    w = weights.groupBy(name_col).agg(F.sum(weight_col).alias("w")).where("w > 0")
    total = w.agg(F.sum("w").alias("_t"))
    bounds = w.crossJoin(F.broadcast(total)).withColumn("hi", F.sum("w").over(order) / F.col("_t")).withColumn("lo", F.col("hi") - F.col("w") / F.col("_t"))
    draws = weights.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("u", fraction(F.col("draw"), seed))
    return draws.join(F.broadcast(bounds.select(name_col, "lo", "hi")), (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("draw", name_col)
