"""Queries of the sanitising run, its metrics and the drift checks."""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.functions import text as T
from termsieve.operators import ner, rules, validation
from termsieve.plans.registry import (
    SQL_ALLOWED, SQL_DICTIONARY, SQL_DOCUMENT_LINES, SQL_DOCUMENT_WORDS, benchmark_words, document_lines, document_words, part_words, query, sql_tokens, sql_words, table,
)
from termsieve.scratch import held, scratch_root
from termsieve.sources.sinks import first_errors

RULE = "CASE WHEN a.word IS NOT NULL THEN 'allowed' WHEN regexp_matches(q.query, '[0-9]') THEN 'number' WHEN contains(q.query, '@') THEN 'at' ELSE 'clean' END"


@query(f"""
WITH {SQL_DOCUMENT_WORDS}, {SQL_ALLOWED}
SELECT lang, rule, count(*) AS n_terms, sum(length(query))::BIGINT AS n_chars, count(DISTINCT query) AS n_distinct
FROM (SELECT q.lang, q.query, {RULE} AS rule FROM words q LEFT JOIN allowed a ON q.query = a.word WHERE regexp_matches(q.query, '\\S'))
GROUP BY lang, rule
""")
def sanitize_terms(spark: SparkSession, d: str) -> DataFrame:
    flagged = rules.flag(document_words(spark, d), benchmark_words(spark, d))
    # Terms repeat a lot: counting them first leaves distinct terms for the distinct count.
    per = flagged.groupBy("lang", "rule", "query").agg(F.count("*").alias("n"))
    return per.groupBy("lang", "rule").agg(F.sum("n").alias("n_terms"), F.sum(F.col("n") * F.length("query")).alias("n_chars"), F.count("*").alias("n_distinct"))


@query(f"""
WITH {SQL_DOCUMENT_LINES}
SELECT doc_id, lang, line_no::INTEGER AS line_no, query FROM lines WHERE NOT regexp_matches(query, '[0-9@]')
""")
def sanitized_lines(spark: SparkSession, d: str) -> DataFrame:
    nothing = spark.createDataFrame([], "word string")
    return rules.sanitized(rules.flag(document_lines(spark, d), nothing))


@query("""
SELECT count(DISTINCT user_id) AS total_search_terms, count(*) FILTER (trim(props, ' ') = '') AS contained_blank, count(*) AS n_rows
FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
""")
def initial_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").where((F.col("event_type") == "view") & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return rows.agg(F.count_distinct("user_id").alias("total_search_terms"), F.count_if(F.btrim("props") == "").alias("contained_blank"), F.count("*").alias("n_rows"))


@query(f"""
WITH {SQL_DOCUMENT_LINES}, ruled AS (
  SELECT query, CASE WHEN regexp_matches(query, '[0-9]') THEN 'number' WHEN contains(query, '@') THEN 'at' ELSE 'clean' END AS rule FROM lines)
SELECT count(*) AS total_analyzed, 0::BIGINT AS in_allow_list, count(*) FILTER (rule = 'number') AS contained_numbers,
  count(*) FILTER (rule = 'at') AS contained_at, 0::BIGINT AS contained_name, count(*) FILTER (rule = 'clean') AS kept,
  coalesce(sum(length(query)) FILTER (rule = 'clean'), 0)::BIGINT AS sum_chars,
  coalesce(sum(length(regexp_replace(query, '[^A-Z]', '', 'g'))) FILTER (rule = 'clean'), 0)::BIGINT AS sum_uppercase_chars,
  coalesce(sum(len({sql_words('query')})) FILTER (rule = 'clean'), 0)::BIGINT AS sum_words,
  count(*) - count(*) FILTER (rule = 'clean') AS removed
FROM ruled
""")
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rules.run_metrics(rules.flag(document_lines(spark, d), spark.createDataFrame([], "word string")))


@query(f"""
WITH {SQL_DOCUMENT_LINES}, names AS (SELECT DISTINCT unnest({sql_tokens('p_name')}) AS word FROM part),
w AS (SELECT doc_id, line_no, unnest({sql_tokens('query')}) AS word FROM lines),
extra AS (SELECT DISTINCT word FROM (SELECT unnest({sql_tokens('text')}) AS word FROM benchmark) WHERE word <> '')
SELECT w.doc_id, count(DISTINCT w.line_no) AS n_hits FROM w WHERE w.word IN (SELECT word FROM names UNION SELECT word FROM extra) GROUP BY w.doc_id
""")
def surname_hits(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select(F.explode(T.tokens(F.col("p_name"))).alias("word"))
    extra = table(spark, d, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("word")).where("word <> ''")
    words = document_lines(spark, d).select("doc_id", "line_no", F.explode(F.array_distinct(T.tokens(F.col("query")))).alias("word"))
    return words.join(names.union(extra).distinct(), "word", "left_semi").groupBy("doc_id").agg(F.count_distinct("line_no").alias("n_hits"))


@query(f"""
WITH {SQL_DOCUMENT_LINES} SELECT lang AS language_code, count(*) AS search_term_count FROM lines WHERE length(query) > 5 GROUP BY lang
""")
def language_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rules.language_counts(document_lines(spark, d), "query", "lang")


@query(f"""
WITH {SQL_DOCUMENT_LINES} SELECT 'run' AS job, lang AS language_code, count(*) AS search_term_count FROM lines WHERE length(query) > 5 GROUP BY lang
""")
def language_json_explode(spark: SparkSession, d: str) -> DataFrame:
    rows = rules.language_json(language_histogram(spark, d)).select(F.lit("run").alias("job"), "languages_json")
    return rules.explode_language_json(rows, "languages_json")


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A run per day of events: clicks are removed terms, and so on; languages are the event types."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    kind = lambda k: F.count_if(F.col("event_type") == k)
    runs = e.groupBy("day").agg(
        F.max("ts").alias("finished_at"), F.count("*").alias("total_search_terms_analyzed"), kind("click").alias("total_search_terms_removed_by_sanitization_job"),
        kind("error").alias("contained_at"), kind("signup").alias("contained_numbers"), kind("purchase").alias("contained_name"),
        F.count_if(F.col("value") > 90).alias("sum_terms_containing_us_census_surname"), F.sum(F.length("props")).alias("sum_chars_all_search_terms"),
        F.sum(F.length("event_type")).alias("sum_uppercase_chars_all_search_terms"), F.sum(F.col("user_id") % 7).alias("sum_words_all_search_terms"),
    ).withColumns({"status": F.lit("SUCCESS"), "started_at": F.col("day")})
    lang = e.withColumn("language_code", F.when(F.col("event_type") == "view", "en").otherwise(F.col("event_type")))
    return runs, lang.groupBy(F.col("day").alias("job_start_time"), "language_code").agg(F.count("*").alias("search_term_count"))


SQL_METRICS = """
metrics AS (
  SELECT max(ts) AS finished_at,
    count(*) FILTER (event_type = 'click') / count(*) AS pct_sanitized_search_terms,
    count(*) FILTER (event_type = 'error') / count(*) AS pct_sanitized_contained_at,
    count(*) FILTER (event_type = 'signup') / count(*) AS pct_sanitized_contained_numbers,
    count(*) FILTER (event_type = 'purchase') / count(*) AS pct_sanitized_contained_name,
    count(*) FILTER (value > 90) / count(*) AS pct_terms_containing_us_census_surname,
    sum(length(event_type))::DOUBLE / sum(length(props))::DOUBLE AS pct_uppercase_chars_all_search_terms,
    sum(user_id % 7)::DOUBLE / count(*) AS avg_words_all_search_terms,
    1 - nullif(count(*) FILTER (event_type = 'view'), 0) / count(*) AS pct_terms_non_english
  FROM events GROUP BY ts::DATE)
"""
METRICS = [c.metric for c in validation.CHECKS]
ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)


@query(f"WITH {SQL_METRICS} SELECT finished_at, {ROUNDED} FROM metrics")
def daily_validation_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = validation.run_ratios(*_runs(spark, d))
    return out.select("finished_at", *[F.round(m, 6).alias(m) for m in METRICS])


TODAY = dt.date(2024, 1, 30)


def _check_sql(metric: str, value: str, lookback: int, window: int, low: float, high: float) -> str:
    lo, mid = f"DATE '2024-01-30' - {lookback + window}", f"DATE '2024-01-30' - {window}"
    return f"""
  SELECT '{metric}' AS metric, count(*) FILTER (day > {lo} AND day <= {mid}) AS num_compared,
    round(quantile_cont(v, {low}) FILTER (day > {lo} AND day <= {mid}), 6) AS low, round(quantile_cont(v, {high}) FILTER (day > {lo} AND day <= {mid}), 6) AS high,
    count(*) FILTER (day > {mid} AND day <= DATE '2024-01-30') AS n_tested,
    coalesce(count(*) FILTER (day > {mid} AND day <= DATE '2024-01-30') > 0 AND (
      min(v) FILTER (day > {mid} AND day <= DATE '2024-01-30') > quantile_cont(v, {high}) FILTER (day > {lo} AND day <= {mid}) OR
      max(v) FILTER (day > {mid} AND day <= DATE '2024-01-30') < quantile_cont(v, {low}) FILTER (day > {lo} AND day <= {mid})), false) AS alarm
  FROM (SELECT finished_at::DATE AS day, {value} AS v FROM metrics)"""


def _short(checked: DataFrame, metric: str) -> DataFrame:
    return checked.select(F.lit(metric).alias("metric"), "num_compared", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), F.size("test_vals").cast("long").alias("n_tested"), "alarm")


LOOKBACK = 20
RANGE_CHECKS = [replace(c, lookback=LOOKBACK) for c in validation.CHECKS]


@query(f"WITH {SQL_METRICS} " + " UNION ALL ".join(_check_sql(c.metric, c.metric, LOOKBACK, c.range_window, c.range_low, c.range_high) for c in RANGE_CHECKS))
def range_check(spark: SparkSession, d: str) -> DataFrame:
    metrics = held(validation.run_ratios(*_runs(spark, d)))
    return functools.reduce(DataFrame.union, [_short(validation.range_check(metrics, c.metric, LOOKBACK, c.range_window, c.range_low, c.range_high, TODAY), c.metric) for c in RANGE_CHECKS])


@query(f"WITH {SQL_METRICS} " + " UNION ALL ".join(
    _check_sql(c.metric, f"avg({c.metric}) OVER (ORDER BY finished_at ROWS {c.moving - 1} PRECEDING)", LOOKBACK, c.mean_window, c.mean_low, c.mean_high) for c in RANGE_CHECKS))
def mean_check(spark: SparkSession, d: str) -> DataFrame:
    metrics = held(validation.run_ratios(*_runs(spark, d)))
    return functools.reduce(DataFrame.union, [_short(validation.mean_check(metrics, c.metric, LOOKBACK, c.mean_window, c.moving, c.mean_low, c.mean_high, TODAY), c.metric) for c in RANGE_CHECKS])


@query(f"""WITH {SQL_METRICS}, r AS ({' UNION ALL '.join(_check_sql(c.metric, c.metric, LOOKBACK, c.range_window, c.range_low, c.range_high) for c in RANGE_CHECKS)}),
m AS ({' UNION ALL '.join(_check_sql(c.metric, f'avg({c.metric}) OVER (ORDER BY finished_at ROWS {c.moving - 1} PRECEDING)', LOOKBACK, c.mean_window, c.mean_low, c.mean_high) for c in RANGE_CHECKS)})
SELECT r.metric, r.alarm AS range_alarm, r.low AS range_low, r.high AS range_high, r.num_compared AS num_ranges_compared,
  m.alarm AS mean_alarm, m.low AS mean_low, m.high AS mean_high, m.num_compared AS num_moving_averages_compared FROM r JOIN m USING (metric)""")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    out = validation.report(validation.run_ratios(*_runs(spark, d)), RANGE_CHECKS, TODAY)
    rounded = [F.round(c, 6).alias(c) for c in ("range_low", "range_high", "mean_low", "mean_high")]
    return out.select("metric", "range_alarm", "num_ranges_compared", "mean_alarm", "num_moving_averages_compared", *rounded)


@query("""
SELECT event_id, user_id::VARCHAR AS session_id, nullif(event_type, 'error') AS country, '{"event_id":' || event_id || ',"type":"' || event_type || '"}' AS record,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, date_trunc('hour', ts) AS hour FROM events
""")
def nested_projection(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    fields = F.struct(F.col("user_id").cast("string").alias("session_id"), F.nullif("event_type", F.lit("error")).alias("country"))
    nested = e.select("event_id", "ts", "event_type", F.struct(F.struct("*").alias("all"), fields.alias("fields")).alias("payload"))
    return nested.select(
        "event_id", "payload.fields.*", F.to_json(F.struct("event_id", F.col("event_type").alias("type"))).alias("record"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"))


@query("""
SELECT event_type, min(CASE WHEN value > 95 THEN event_id END) AS first_bad, count(*) FILTER (value > 95) AS n_errors FROM events GROUP BY event_type
""")
def insert_error_first(spark: SparkSession, d: str) -> DataFrame:
    bad = F.when(F.col("value") > 95, F.array(F.col("event_id"), F.col("event_id") + 1))
    rows = table(spark, d, "events").groupBy("event_type", (F.col("event_id") % 8).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("index"), bad.alias("errors")))).alias("rows"))
    errors = rows.groupBy("event_type").agg(first_errors(F.collect_list("rows")).alias("errors"))
    return errors.select("event_type", F.array_min("errors").alias("first_bad"), F.size("errors").cast("long").alias("n_errors"))


@query(f"""
WITH {SQL_DOCUMENT_LINES}, {SQL_DICTIONARY}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (regexp_matches(query, '[0-9]')) AS n_number,
  count(*) FILTER (NOT regexp_matches(query, '[0-9]') AND contains(query, '@')) AS n_at FROM lines GROUP BY doc_id
""")
def rule_counts(spark: SparkSession, d: str) -> DataFrame:
    flagged = rules.flag(document_lines(spark, d), spark.createDataFrame([], "word string"))
    return flagged.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.col("rule") == "number").alias("n_number"), F.count_if(F.col("rule") == "at").alias("n_at"))


_LISTED = "[" + ", ".join(f"'{n}'" for n in (*ner.FORENAMES, *ner.TITLES)) + "]"
_FREQUENT = "[" + ", ".join(f"'{w}'" for w in ner.FREQUENT) + "]"
_EDGES, _WORD = ner.EDGES.replace("'", "''"), ner.WORD.replace("'", "''")


@query(f"""
WITH {SQL_DOCUMENT_LINES}, cut AS (SELECT doc_id, line_no, query, {sql_words('query')} AS w FROM lines),
bare AS (SELECT *, list_transform(w, lambda x: regexp_replace(lower(x), '{_EDGES}', '', 'g')) AS b FROM cut)
SELECT doc_id, line_no::INTEGER AS line_no, CASE WHEN regexp_matches(query, '[0-9]') THEN 'number' WHEN contains(query, '@') THEN 'at'
  WHEN len(list_filter(range(1, len(w)), lambda i: list_contains({_LISTED}, b[i]) AND regexp_matches(w[i + 1], '{_WORD}') AND NOT list_contains({_FREQUENT}, b[i + 1]))) > 0 THEN 'name' ELSE 'clean' END AS rule
FROM bare
""")
def person_flag(spark: SparkSession, d: str) -> DataFrame:
    return ner.flag_names(document_lines(spark, d), "query").select("doc_id", "line_no", "rule")


@query(f"""
WITH {SQL_DOCUMENT_LINES}, {SQL_ALLOWED}
SELECT doc_id, lang, line_no::INTEGER AS line_no, query FROM lines WHERE NOT regexp_matches(query, '[0-9@]') OR query IN (SELECT word FROM allowed)
""")
def stream_sanitize(spark: SparkSession, d: str) -> DataFrame:
    """The same plan over a stream of files, read back from the sink."""
    from termsieve.streaming.sanitize import sanitize_stream

    base = f"{scratch_root(spark)}/stream-{spark.sparkContext.applicationId}-{dt.datetime.now().timestamp()}"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    expand = lambda rows: rows.select("doc_id", "lang", F.posexplode(T.lines(F.col("text"))).alias("line_no", "query"))
    source = d if "://" in d else f"file://{d}"
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes)
    sanitize_stream(spark, f"{source}/documents.parquet*", schema, benchmark_words(spark, d), "query", f"{base}/sink", f"{base}/state", expand)
    return spark.read.parquet(f"{base}/sink").drop("batch")
