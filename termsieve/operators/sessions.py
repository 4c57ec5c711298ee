"""Sessions of queries: the last query, and queries that were only typed on the way to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsieve.scratch import held


def terminal_queries(rows: DataFrame, session_col: str, order_col: str | Column) -> DataFrame:
    """The row with the largest order of each session that has an id: a partially aggregated arg-max."""
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    last = rows.where(F.col(session_col).isNotNull()).groupBy(session_col).agg(F.max_by(F.struct(*rows.columns), order).alias("_row"))
    return last.select("_row.*")


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def prefix_links(rows: DataFrame, ts_col: str, query_col: str, row_col: str, window_s: float, min_diff: int, max_diff: int,
                 partition: Sequence[str] = ()) -> DataFrame:
    """(row, prefix_of): for each row the first later row within [t, t + window) that it is a prefix of, if any.

    row_col orders rows of equal time and must rise with time. Longer queries are put under each of their prefixes
    that are min_diff to max_diff characters shorter, by buckets of the window's length; a row looks for the next one
    under its own text, in its bucket and the one after. So rows are sorted under their prefixes, never paired, and one
    text typed very often costs no more than a sort.
    """
    w = int(round(window_s * 1_000_000))
    t = _micros(F.col(ts_col))
    base = rows.select(*partition, F.col(row_col).alias("_i"), F.col(query_col).alias("_q"), t.alias("_t"))
    base = base.withColumn("_b", F.floor(F.col("_t") / F.lit(w)))
    long = F.lit(False).alias("_long")
    left = base.select(*partition, "_i", "_t", "_q", F.explode(F.array("_b", F.col("_b") + 1)).alias("_look"), long)
    cuts = base.withColumn("_d", F.explode(F.sequence(F.lit(min_diff), F.lit(max_diff)))).where(F.length("_q") >= F.col("_d"))
    right = cuts.select(*partition, "_i", "_t", F.substring("_q", F.lit(1), F.length("_q") - F.col("_d")), F.col("_b"), F.lit(True))
    order = Window.partitionBy(*partition, "_look", "_q").orderBy(F.desc("_i"), "_long").rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col("_long"), F.struct("_i", "_t")), ignorenulls=True).over(order)
    met = left.union(right).where("_q IS NOT NULL").withColumn("_next", following).where("NOT _long AND _next IS NOT NULL")
    met = met.where((F.col("_next._t") - F.col("_t") < w) & (F.col("_next._t") >= F.col("_t")))
    return met.groupBy(F.col("_i").alias(row_col)).agg(F.min("_next._i").alias("prefix_of"))


def full_query_roots(links: DataFrame, row_col: str = "row", rounds: int = 40) -> DataFrame:
    """(row, full_query_idx): the end of each chain of prefixes, by pointer jumping; a link always leads forward."""
    now = links.select(F.col(row_col).alias("_i"), F.col("prefix_of").alias("_r"))
    for _ in range(rounds):
        to = now.select(F.col("_i").alias("_r"), F.col("_r").alias("_next"))
        jumped = now.join(to, "_r", "left").select("_i", F.coalesce("_next", "_r").alias("_r"), F.col("_next").isNotNull().alias("_moved"))
        jumped = held(jumped)
        moved = jumped.where("_moved").limit(1).count()
        now = jumped.select("_i", "_r")
        if not moved:
            break
    return now.select(F.col("_i").alias(row_col), F.col("_r").alias("full_query_idx"))


def label_intermediate(rows: DataFrame, ts_col: str, query_col: str, window_s: float = 1.0, min_diff: int = 1, max_diff: int = 3,
                       partition: Sequence[str] = (), row_col: str | None = None) -> DataFrame:
    """The rows with their index in time order, is_prefix, prefix_of (-1: none) and full_query_idx.

    Without row_col, rows are numbered by time over the whole input, which puts them into one task; give a column
    that rises with time to avoid that.
    """
    if row_col is None:
        row_col = "row"
        rows = rows.withColumn(row_col, F.row_number().over(Window.orderBy(ts_col, query_col)).cast("long") - 1)
    links = prefix_links(rows, ts_col, query_col, row_col, window_s, min_diff, max_diff, partition)
    roots = full_query_roots(links, row_col)
    out = rows.join(links, row_col, "left").join(roots, row_col, "left")
    return out.select(
        *rows.columns, F.col("prefix_of").isNotNull().alias("is_prefix"), F.coalesce("prefix_of", F.lit(-1)).cast("long").alias("prefix_of"),
        F.coalesce("full_query_idx", F.col(row_col)).cast("long").alias("full_query_idx"),
    )
