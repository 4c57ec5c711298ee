"""Readers of logs, lists, page dumps and graph statements."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.functions.text import blank, null_if_none
from termsieve.operators.sessions import terminal_queries

LOG_FIELDS = ("rid", "session_id", "sequence_no", "query", "country", "region", "dma", "form_factor", "browser", "os_family")
LOG_SCHEMA = f"timestamp timestamp, jsonPayload struct<type:string,fields:struct<{','.join(f'{c}:string' for c in LOG_FIELDS)}>>"
SUGGEST = "web.suggest.request"


def parse_run_date(value: str, today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """[start, end) of a run: 'latest' is yesterday in UTC, else an ISO date."""
    start = (today or dt.datetime.now(dt.UTC).date()) - dt.timedelta(days=1) if value == "latest" else dt.date.fromisoformat(value)
    return start, start + dt.timedelta(days=1)


def checked_name(name: str) -> str:
    """A table name that is safe to put into SQL text."""
    if not re.fullmatch(r"[A-Za-z0-9.\-_]+", name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def day_of_logs(logs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Flat rows of suggest requests in [start, end); geographic 'none' is null, blank and null queries are out.

    The range is put as timestamps, which reaches the Parquet scan.
    """
    f = lambda c: F.col(f"jsonPayload.fields.{c}")
    rows = logs.where((F.col("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("timestamp") < F.lit(end).cast("timestamp")))
    rows = rows.where((F.col("jsonPayload.type") == SUGGEST) & ~blank(f("query")))
    geo = {"country", "region", "dma"}
    rest = [(null_if_none(f(c)) if c in geo else f(c)).alias(c) for c in LOG_FIELDS[1:]]
    return rows.select("timestamp", f("rid").alias("request_id"), *rest)


def allow_list(suggestions: DataFrame) -> DataFrame:
    """Distinct keywords of all suggestions."""
    return suggestions.select(F.explode("keywords").alias("word")).distinct()


def term_stats(logs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Distinct requests and blank queries of the day's suggest requests."""
    rows = logs.where((F.col("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("timestamp") < F.lit(end).cast("timestamp")))
    rows = rows.where(F.col("jsonPayload.type") == SUGGEST)
    return rows.agg(F.count_distinct("jsonPayload.fields.rid").alias("total_search_terms"), F.count_if(blank(F.col("jsonPayload.fields.query"))).alias("contained_blank"))


def research_queries(logs: DataFrame, truncate_ts: bool = True, terminal_only: bool = False) -> DataFrame:
    """query_timestamp (cut to the hour if asked), query, session_id, sequence_no of suggest requests.

    terminal_only: the request of the highest sequence_no of each session alone; those without a session are out.
    """
    ts = F.date_trunc("HOUR", F.col("timestamp")) if truncate_ts else F.col("timestamp")
    rows = logs.where(F.col("jsonPayload.type") == SUGGEST)
    rows = rows.select(ts.alias("query_timestamp"), *[F.col(f"jsonPayload.fields.{c}").alias(c) for c in ("query", "session_id", "sequence_no")])
    return terminal_queries(rows, "session_id", F.col("sequence_no").cast("long")) if terminal_only else rows


def run_query(spark: SparkSession, sql: str, **args) -> DataFrame:
    return spark.sql(sql, args=args)


def surnames(spark: SparkSession, path: str, keep_null_name: bool = True) -> DataFrame:
    """Distinct lower-cased surnames of a CSV with a name column; the row of all other names is left out by its name."""
    rows = spark.read.option("header", True).option("nullValue", "\0").csv(path)
    rows = rows.where(F.col("name") != "ALL OTHER NAMES")
    if not keep_null_name:
        rows = rows.where(F.lower("name") != "null")
    return rows.select(F.lower("name").alias("surname")).distinct()


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed words of a text file, a line each."""
    return spark.read.text(path).select(F.btrim("value").alias("word")).where("word <> ''").distinct()


def fixed_width_names(spark: SparkSession, path: str) -> DataFrame:
    """forename, pct, cumpct, rank of a file of aligned columns."""
    cut = spark.read.text(path).where(F.btrim("value") != "").select(F.split(F.btrim("value"), r"\s+").alias("c"))
    return cut.select(F.lower(F.col("c")[0]).alias("forename"), F.col("c")[1].cast("double").alias("pct"), F.col("c")[2].cast("double").alias("cumpct"), F.col("c")[3].cast("int").alias("rank"))


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True, line_ends: bool = False) -> DataFrame:
    """CSV or TSV, plain or gzipped, with a declared schema. line_ends: quotes may hold them; files aren't split then."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("multiLine", line_ends).option("escape", '"').csv(path)


def labelled_queries(spark: SparkSession, path: str) -> DataFrame:
    """query, language, category, expected_ner_removal of a labelled CSV."""
    return delimited(spark, path, "query string, language string, category string, expected_ner_removal boolean", line_ends=True)


def bulk_json(spark: SparkSession, path: str, schema: str, max_records: int | None = None) -> DataFrame:
    """Records of a bulk dump of JSON lines; an index line is one whose only key is index, wherever it stands."""
    index = F.coalesce(F.json_object_keys("value") == F.array(F.lit("index")), F.lit(False))
    rows = spark.read.text(path).where(~index & ~blank(F.col("value")))
    rows = rows.select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows.limit(max_records) if max_records is not None else rows


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, failures): lines that parse, and the text of those that don't."""
    rows = spark.read.text(path).where(F.btrim("value") != "")
    parsed = rows.select("value", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = parsed.where(F.col("r._bad").isNull() & F.col("r").isNotNull()).select("r.*").drop("_bad")
    return good, parsed.where(F.col("r._bad").isNotNull() | F.col("r").isNull()).select(F.col("value").alias("line"))


def statements(spark: SparkSession, path: str) -> DataFrame:
    """One row per Turtle statement: statements end in ' .' before a line end."""
    rows = spark.read.option("lineSep", " .\n").text(path)
    return rows.where(F.btrim("value") != "").select(F.btrim("value", F.lit(" \n\t.")).alias("statement"))


def parse_statements(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(info, linkage) of category statements: key, name, hidden, num_pages, num_subcats; and key, parents (keys)."""
    s = F.col("statement")
    key = F.regexp_extract(s, r"^<[^>]*/Category:([^>]*)>", 1)
    linked = s.contains("isInCategory")
    number = lambda p: F.regexp_extract(s, rf':{p} "?(\d+)"?', 1)
    info = rows.where(~linked & (key != "")).select(
        key.alias("key"), F.regexp_extract(s, r'label "((?:[^"\\]|\\.)*)"', 1).alias("name"), s.contains("HiddenCategory").alias("hidden"),
        F.nullif(number("pages"), F.lit("")).cast("long").alias("num_pages"),
        F.nullif(number("subcategories"), F.lit("")).cast("long").alias("num_subcats"))
    tail = F.regexp_replace(s, r"^[^>]*>", "")
    linkage = rows.where(linked & (key != "")).select(key.alias("key"), F.regexp_extract_all(tail, F.lit("/Category:([^>]*)>"), F.lit(1)).alias("parents"))
    return info, linkage
