"""Sinks: day partitions, samples, run metadata, reports and managed tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of a run's metadata.
METADATA = (
    "status string, total_search_terms long, total_search_terms_analyzed long, total_search_terms_appearing_in_allow_list long, "
    "total_search_terms_removed_by_sanitization_job long, contained_blank long, contained_numbers long, contained_at long, contained_name long, "
    "sum_chars_all_search_terms long, sum_uppercase_chars_all_search_terms long, sum_words_all_search_terms long, "
    "sum_terms_containing_us_census_surname long, approximate_language_proportions_json string, failure_reason string, "
    "started_at string, finished_at string, implementation_notes string"
)
STAMP = "%Y-%m-%d %H:%M:%S"


def overwrite_day(rows: DataFrame, path: str, day: dt.date) -> None:
    """Replaces one day's partition (column date) and no other, be it by nothing: a rerun leaves its own rows alone.

    The rows are written aside, hidden from readers, and take the partition's place when they are all there.
    """
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    aside, final = hadoop.Path(f"{path}/_new-{uuid.uuid4().hex}"), hadoop.Path(f"{path}/date={day.isoformat()}")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        rows.drop("date").write.parquet(aside.toString())
        fs.delete(final, True)
        if not fs.rename(aside, final):
            raise OSError(f"could not move {aside} to {final}")
    finally:
        fs.delete(aside, True)


def overwrite_sample_day(rows: DataFrame, path: str, day: dt.date) -> None:
    """The raw sample's own way out; it holds sensitive rows and is kept apart from the sanitised sink."""
    overwrite_day(rows, path, day)


def append_metadata(spark: SparkSession, path: str, **fields) -> None:
    """One row of a run, successful or failed; times are stored as text to the second, counts of languages as JSON."""
    names = [c.split()[0] for c in METADATA.split(", ")]
    if unknown := set(fields) - {*names, "languages"}:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    fields = {"approximate_language_proportions_json": json.dumps(fields.pop("languages", None), sort_keys=True)} | fields
    row = [v.strftime(STAMP) if isinstance(v := fields.get(n), dt.datetime) else v for n in names]
    spark.createDataFrame([row], METADATA).write.mode("append").parquet(path)


def append_rows(rows: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Appends the declared columns in their order."""
    rows.select(*columns).write.mode("append").parquet(path)


def append_report(report: DataFrame, path: str) -> None:
    """The drift report; lists are kept and also written as JSON text."""
    lists = [c for c, t in report.dtypes if t.startswith("array")]
    report.withColumns({f"{c}_json": F.to_json(c) for c in lists}).write.mode("append").parquet(path)


def write_csv(rows: DataFrame, path: str, columns: Sequence[str]) -> None:
    rows.select(*columns).write.option("header", True).mode("overwrite").csv(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Gzipped JSON, a record a line."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").mode("overwrite").text(path)


def first_errors(results: Column) -> Column:
    """The first error of every failing row, over all chunks of an array<array<struct<index, errors>>>."""
    bad = lambda chunk: F.filter(chunk, lambda r: r["errors"].isNotNull() & (F.size(r["errors"]) > 0))
    return F.flatten(F.transform(results, lambda chunk: F.transform(bad(chunk), lambda r: r["errors"][0])))


def dated_table(prefix: str, rows: DataFrame, ts_col: str = "query_timestamp") -> str:
    """A table name with the day of the earliest row."""
    return f"{prefix}_{rows.agg(F.date_format(F.min(ts_col), 'yyyyMMdd')).first()[0]}"


class Table:
    """A managed table; it must be created or loaded before it is written to."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.ready = spark, name, False

    def create(self, rows: DataFrame) -> Table:
        rows.write.mode("overwrite").saveAsTable(self.name)
        self.ready = True
        return self

    def load(self) -> Table:
        if not self.spark.catalog.tableExists(self.name):
            raise ValueError(f"no table {self.name}")
        self.ready = True
        return self

    def _check(self) -> None:
        if not self.ready:
            raise ValueError("create or load the table first")

    def rows(self) -> DataFrame:
        self._check()
        return self.spark.table(self.name)

    def insert(self, rows: DataFrame, overwrite: bool = False) -> None:
        self._check()
        rows.write.mode("overwrite" if overwrite else "append").saveAsTable(self.name)
