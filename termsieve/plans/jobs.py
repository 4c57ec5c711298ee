"""The jobs from the command line: a day's sanitising run, its metrics, and the drift validation."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termsieve.operators import ner, rules, sampling, validation
from termsieve.scratch import held
from termsieve.sources import readers, sinks


class JsonLines(logging.Formatter):
    """Log records as JSON, with seconds since the record before."""

    last = 0.0

    def format(self, record: logging.LogRecord) -> str:
        since, self.last = record.created - (self.last or record.created), record.created
        return json.dumps({"time": record.created, "level": record.levelname, "message": record.getMessage(), "delta_s": round(since, 3)})


def logger() -> logging.Logger:
    log = logging.getLogger("termsieve")
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(JsonLines())
        log.addHandler(handler)
        log.setLevel(logging.INFO)
    return log


def sanitize_day(spark: SparkSession, logs, suggestions, surnames, run_date: str, sink: str, sample_sink: str, metadata: str, detector=None) -> dict:
    """Reads a day, writes the clean rows and one metadata row, and then the 1 % raw sample.

    A failure is recorded with its reason and raised again. The day's partition is always replaced, even by nothing.
    """
    log, started, began = logger(), dt.datetime.now(dt.UTC), time.time()
    start, end = readers.parse_run_date(run_date)
    try:
        stats = readers.term_stats(logs, start, end).first()
        rows = readers.day_of_logs(logs, start, end)
        flagged = rules.flag(rows, readers.allow_list(suggestions))
        model = ner.annotate(detector)  # sees only what no cheap rule decides, and once
        seen = flagged.where("rule = 'clean'").withColumn("_m", model("query"))
        seen = seen.select(*rows.columns, "present_in_allow_list", F.when(F.col("_m.has_person"), "name").otherwise("clean").alias("rule"), "_m.language", "_m.score")
        flagged = held(flagged.where("rule <> 'clean'").unionByName(seen, allowMissingColumns=True))
        clean = rules.sanitized(flagged).drop("language", "score")
        sinks.overwrite_day(clean, sink, start)
        m = rules.run_metrics(flagged, "query", surnames).first()
        spoken = flagged.where("rule = 'clean'")
        languages = {r.language_code: r.search_term_count for r in rules.language_counts(spoken, "query", "language", "score").collect()}
        fields = {
            "total_search_terms": stats.total_search_terms, "contained_blank": stats.contained_blank, "total_search_terms_analyzed": m.total_analyzed,
            "total_search_terms_appearing_in_allow_list": m.in_allow_list, "total_search_terms_removed_by_sanitization_job": m.removed,
            "contained_numbers": m.contained_numbers, "contained_at": m.contained_at, "contained_name": m.contained_name,
            "sum_chars_all_search_terms": m.sum_chars, "sum_uppercase_chars_all_search_terms": m.sum_uppercase_chars,
            "sum_words_all_search_terms": m.sum_words, "sum_terms_containing_us_census_surname": m.terms_with_surname, "languages": languages,
        }
        sinks.append_metadata(spark, metadata, status="SUCCESS", started_at=started, finished_at=dt.datetime.now(dt.UTC), **fields)
        log.info("sanitised %s in %.1f s", start, time.time() - began)
    except Exception as e:
        sinks.append_metadata(spark, metadata, status="FAILURE", failure_reason=str(e)[:1000], started_at=started, finished_at=dt.datetime.now(dt.UTC))
        raise
    sinks.overwrite_sample_day(sampling.share(rows, "request_id", 0.01), sample_sink, start)
    return fields


def record_metrics(spark: SparkSession, metadata: str, languages: str, metrics: str) -> int:
    """Feeds the validation: language counts and ratios of the successful runs that the tables don't have yet.

    languages (job_start_time, language_code, search_term_count) and metrics are tables and created if need be; a rerun
    adds nothing. Returns the number of runs added. A run without languages has no ratios.
    """
    stamp = lambda c: F.to_timestamp(c).alias(c)
    runs = spark.read.parquet(metadata).where("status = 'SUCCESS'").withColumns({"started_at": stamp("started_at"), "finished_at": stamp("finished_at")})
    if spark.catalog.tableExists(metrics):
        runs = runs.join(spark.table(readers.checked_name(metrics)).select("finished_at").distinct(), "finished_at", "left_anti")
    runs = held(runs)
    text = runs.select(F.col("started_at").alias("job_start_time"), "approximate_language_proportions_json")
    spoken = held(rules.explode_language_json(text, "approximate_language_proportions_json"))
    ratios = held(validation.run_ratios(runs, spoken))
    spoken.write.mode("append").saveAsTable(readers.checked_name(languages))
    ratios.write.mode("append").saveAsTable(readers.checked_name(metrics))
    return ratios.count()


def validate(spark: SparkSession, metrics: str, destination: str, today: dt.date | None = None) -> int:
    """Checks the eight metrics of the newest runs and appends the report; returns the number of alarms."""
    rows = spark.table(readers.checked_name(metrics)).orderBy("finished_at")
    report = held(validation.report(rows, today=today))
    sinks.append_report(report, destination)
    return report.where(F.col("range_alarm") | F.col("mean_alarm")).count()


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="termsieve")
    jobs = parser.add_subparsers(dest="job", required=True)
    run = jobs.add_parser("sanitize")
    run.add_argument("--run_date", default="latest")
    for name in ("logs", "suggestions", "surnames", "sink", "sample_sink", "metadata"):
        run.add_argument(f"--{name}", required=True)
    feed = jobs.add_parser("metrics")
    for name in ("metadata", "languages", "metrics"):
        feed.add_argument(f"--{name}", required=True)
    check = jobs.add_parser("validate")
    check.add_argument("--metrics", required=True)
    check.add_argument("--destination", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName(f"termsieve-{a.job}").getOrCreate()
    if a.job == "validate":
        validate(spark, a.metrics, a.destination)
    elif a.job == "metrics":
        record_metrics(spark, a.metadata, a.languages, a.metrics)
    else:
        logs = spark.read.schema(readers.LOG_SCHEMA).parquet(a.logs)
        names = readers.surnames(spark, a.surnames)
        sanitize_day(spark, logs, spark.read.parquet(a.suggestions), names, a.run_date, a.sink, a.sample_sink, a.metadata)


if __name__ == "__main__":
    main()
