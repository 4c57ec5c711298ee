"""Drift checks over the metrics of past runs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """Windows in days and percentile bounds of one metric's two checks."""

    metric: str
    range_window: int
    range_low: float
    range_high: float
    mean_window: int
    mean_low: float
    mean_high: float
    moving: int
    lookback: int = 90


#: The published parameters of the eight metrics.
CHECKS = (
    Check("pct_sanitized_search_terms", 4, 0.125, 0.875, 8, 0.01, 0.99, 7),
    Check("pct_sanitized_contained_at", 4, 0.125, 0.875, 8, 0.025, 0.975, 7),
    Check("pct_sanitized_contained_numbers", 3, 0.075, 0.925, 8, 0.01, 0.99, 7),
    Check("pct_sanitized_contained_name", 5, 0.025, 0.975, 7, 0.01, 0.99, 7),
    Check("pct_terms_containing_us_census_surname", 3, 0.1, 0.9, 8, 0.01, 0.99, 9),
    Check("pct_uppercase_chars_all_search_terms", 4, 0.075, 0.925, 8, 0.01, 0.99, 7),
    Check("avg_words_all_search_terms", 4, 0.125, 0.875, 8, 0.025, 0.975, 7),
    Check("pct_terms_non_english", 4, 0.125, 0.875, 8, 0.01, 0.99, 5),
)


MEAN = "_mean"


def run_ratios(runs: DataFrame, languages: DataFrame) -> DataFrame:
    """The eight ratios of every successful run that has language counts.

    runs: the metadata columns of a run; languages: job_start_time, language_code, search_term_count. A ratio over
    nothing is null, and so is the non-English share of a run without an English row.
    """
    per = languages.groupBy("job_start_time").agg(
        F.max(F.when(F.col("language_code") == "en", F.col("search_term_count"))).alias("_en"), F.sum("search_term_count").alias("_all")
    )
    both = runs.where("status = 'SUCCESS'").join(per, F.col("started_at") == F.col("job_start_time"))
    over = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    n = "total_search_terms_analyzed"
    return both.select(
        "finished_at",
        over("total_search_terms_removed_by_sanitization_job", n).alias("pct_sanitized_search_terms"),
        over("contained_at", n).alias("pct_sanitized_contained_at"),
        over("contained_numbers", n).alias("pct_sanitized_contained_numbers"),
        over("contained_name", n).alias("pct_sanitized_contained_name"),
        over("sum_terms_containing_us_census_surname", n).alias("pct_terms_containing_us_census_surname"),
        over("sum_uppercase_chars_all_search_terms", "sum_chars_all_search_terms").alias("pct_uppercase_chars_all_search_terms"),
        over("sum_words_all_search_terms", n).alias("avg_words_all_search_terms"),
        (1 - over("_en", "_all")).alias("pct_terms_non_english"),
    )


#: The messages are fixed values.
def _guard(name: str, low: float, high: float, metrics: DataFrame, metric: str) -> None:
    if not (0 < low < 1 and 0 < high < 1):
        raise ValueError(f"{name}_lower_bound and {name}_upper_bound should both be between zero (0) and one (1).")
    if "finished_at" not in metrics.columns:
        raise ValueError("dataframe must include a finished_at column.")
    if metric not in metrics.columns:
        raise ValueError(f'dataframe does not include target metric "{metric}"')


def _apart(values: Column, low: Column, high: Column) -> Column:
    """Whether there are values and all of them lie above the high bound, or all below the low one."""
    no = F.lit(False)
    out = F.forall(values, lambda x: F.coalesce(x > high, no)) | F.forall(values, lambda x: F.coalesce(x < low, no))
    return F.coalesce((F.size(values) > 0) & out, no)


def _checked(rows: DataFrame, value: str, lookback: int, window: int, low: float, high: float, today: dt.date | Column) -> DataFrame:
    """latest, n, trigger, low, high, values: of the comparison window before the test window, both (from, to]."""
    anchor = today if isinstance(today, Column) else F.lit(today)
    day = F.to_date("finished_at")
    start, split = F.date_sub(anchor, lookback + window), F.date_sub(anchor, window)
    before = (day > start) & (day <= split)
    tested = (day > split) & (day <= anchor)
    v = F.col(value).cast("double")
    counted = F.count(F.when(before, v)) if value == MEAN else F.count_if(before)
    bounds = rows.agg(
        F.percentile(F.when(before, v), F.array(F.lit(low), F.lit(high))).alias("_p"),
        counted.alias("num_compared"),
        F.max("finished_at").alias("latest_finished_at"),
        F.transform(F.array_sort(F.collect_list(F.when(tested, F.struct("finished_at", v.alias("v"))))), lambda x: x["v"]).alias("test_vals"),
    )
    bounds = bounds.withColumns({"low": F.element_at("_p", 1), "high": F.element_at("_p", 2)})
    return bounds.select("latest_finished_at", "num_compared", _apart(F.col("test_vals"), F.col("low"), F.col("high")).alias("alarm"), "low", "high", "test_vals")


def range_check(metrics: DataFrame, metric: str, lookback: int, window: int, low: float, high: float, today: dt.date | Column | None = None) -> DataFrame:
    """One row: alarm if every test value lies strictly outside the comparison window's percentiles, on one side."""
    _guard("range", low, high, metrics, metric)
    return _checked(metrics, metric, lookback, window, low, high, today if today is not None else F.current_date())


def mean_check(metrics: DataFrame, metric: str, lookback: int, window: int, moving: int, low: float, high: float, today: dt.date | Column | None = None) -> DataFrame:
    """The same over moving averages of `moving` runs, taken over the whole history; early ones are of fewer runs."""
    _guard("mean", low, high, metrics, metric)
    order = Window.orderBy("finished_at").rowsBetween(-(moving - 1), 0)  # a row per run: one task holds the history
    averaged = metrics.select("finished_at", F.avg(metric).over(order).alias(MEAN))
    return _checked(averaged, MEAN, lookback, window, low, high, today if today is not None else F.current_date())


def report(metrics: DataFrame, checks=CHECKS, today: dt.date | Column | None = None) -> DataFrame:
    """One row per metric with both checks' bounds, values and alarms, each with its own parameters.

    The metrics become rows, and one grouped aggregate gives all checks.
    """
    for c in checks:
        _guard("range", c.range_low, c.range_high, metrics, c.metric)
        _guard("mean", c.mean_low, c.mean_high, metrics, c.metric)
    anchor = today if isinstance(today, Column) else F.lit(today) if today is not None else F.current_date()
    kinds = "metric string, range_window int, range_low double, range_high double, mean_window int, mean_low double, mean_high double, moving int, lookback int"
    given = metrics.sparkSession.createDataFrame([tuple(getattr(c, n.split()[0]) for n in kinds.split(", ")) for c in checks], kinds)
    names = [c.metric for c in checks]
    rows = metrics.select("finished_at", *[F.col(m).cast("double").alias(m) for m in names]).unpivot(["finished_at"], names, "metric", "v")
    rows = rows.join(F.broadcast(given), "metric")  # a row per metric
    average = F.lit(None).cast("double")
    for n in sorted({c.moving for c in checks}):
        order = Window.partitionBy("metric").orderBy("finished_at").rowsBetween(-(n - 1), 0)
        average = F.when(F.col("moving") == n, F.avg("v").over(order)).otherwise(average)
    rows = rows.withColumns({"mean": average, "_day": F.to_date("finished_at")})
    bounds = sorted({x for c in checks for x in (c.range_low, c.range_high, c.mean_low, c.mean_high)})
    levels = F.array(*[F.lit(b) for b in bounds])
    aggs = [F.max("finished_at").alias("from_sanitization_job_finished_at")]
    for kind, value in (("range", "v"), ("mean", "mean")):
        start, split = F.date_sub(anchor, F.col("lookback") + F.col(f"{kind}_window")), F.date_sub(anchor, F.col(f"{kind}_window"))
        before, tested = (F.col("_day") > start) & (F.col("_day") <= split), (F.col("_day") > split) & (F.col("_day") <= anchor)
        aggs += [
            F.percentile(F.when(before, F.col(value)), levels).alias(f"_{kind}"),
            (F.count_if(before) if kind == "range" else F.count(F.when(before, F.col(value)))).alias(f"_{kind}_n"),
            F.transform(F.array_sort(F.collect_list(F.when(tested, F.struct("finished_at", F.col(value).alias("v"))))), lambda x: x["v"]).alias(f"_{kind}_tested"),
        ]
    out = given.join(rows.groupBy("metric").agg(*aggs), "metric", "left")
    out = out.withColumn("from_sanitization_job_finished_at", F.max("from_sanitization_job_finished_at").over(Window.partitionBy(F.lit(1))))  # a row per metric
    cols = []
    for kind, counted in (("range", "num_ranges_compared"), ("mean", "num_moving_averages_compared")):
        pick = lambda b, kind=kind: F.try_element_at(F.col(f"_{kind}"), F.array_position(levels, F.col(f"{kind}_{b}")).cast("int"))
        low, high, tested = pick("low"), pick("high"), F.coalesce(f"_{kind}_tested", F.array().cast("array<double>"))
        cols += [
            _apart(tested, low, high).alias(f"{kind}_alarm"), low.alias(f"_{kind}_low"), high.alias(f"_{kind}_high"),
            F.coalesce(f"_{kind}_n", F.lit(0)).alias(counted), tested.alias(f"{kind}_test_vals"),
        ]
    out = out.select("*", *cols)
    return out.select(
        "from_sanitization_job_finished_at", "range_alarm", F.col("_range_low").alias("range_low"), F.col("_range_high").alias("range_high"), "num_ranges_compared",
        "range_test_vals", "mean_alarm", F.col("_mean_low").alias("mean_low"), F.col("_mean_high").alias("mean_high"), "num_moving_averages_compared", "mean_test_vals",
        "metric", F.col("lookback").alias("full_lookback_window_num_days"), F.col("range_window").alias("range_test_window_num_days"),
        F.col("mean_window").alias("mean_test_window_num_days"), F.col("moving").alias("moving_average_window_num_days"),
        F.col("range_low").alias("range_percentile_lower_bound"), F.col("range_high").alias("range_percentile_upper_bound"),
        F.col("mean_low").alias("mean_percentile_lower_bound"), F.col("mean_high").alias("mean_percentile_upper_bound"), F.current_timestamp().alias("started_at"),
    )
