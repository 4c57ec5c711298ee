"""The ordered rules for terms that may hold personal information, and the metrics of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.functions import text as T

EMPTY_QUERY = "FX_RECEIVED_EMPTY_QUERY"


def rule(query: Column) -> Column:
    """'number', then 'at', else null: a term falls under the first rule that fits."""
    return F.when(T.has_digit(query), "number").when(query.contains("@"), "at")


def contains_pii(query: Column, person: Column | None = None) -> Column:
    """Whether any rule fits, the name rule included if a person flag is given."""
    plain = F.coalesce(query.rlike("[0-9@]"), F.lit(False))
    return plain if person is None else plain | F.coalesce(person, F.lit(False))


def flag(queries: DataFrame, allowed: DataFrame, query_col: str = "query", allowed_col: str = "word") -> DataFrame:
    """The queries with present_in_allow_list and rule.

    The allow-list is matched exactly and case-sensitively; its terms pass whatever the rules say. Blank queries
    are left out; null ones fall under no rule, and run_metrics() counts them as a placeholder. The list is made distinct, so the join adds no rows, and Spark broadcasts it only while
    its size is under the session's threshold.
    """
    listed = allowed.select(F.col(allowed_col).alias("_allowed")).distinct()
    rows = queries.where(~F.coalesce(T.blank(F.col(query_col)), F.lit(False)))
    rows = rows.join(listed, F.col(query_col) == F.col("_allowed"), "left")
    rows = rows.withColumn("present_in_allow_list", F.col("_allowed").isNotNull()).drop("_allowed")
    return rows.withColumn("rule", F.when(F.col("present_in_allow_list"), F.lit("allowed")).otherwise(F.coalesce(rule(F.col(query_col)), F.lit("clean"))))


def sanitized(flagged: DataFrame) -> DataFrame:
    """The rows that may be kept: allow-listed or under no rule; without the working columns."""
    return flagged.where(F.col("rule").isin("allowed", "clean")).drop("rule", "present_in_allow_list")


def run_metrics(flagged: DataFrame, query_col: str = "query", surnames: DataFrame | None = None) -> DataFrame:
    """One row of counts by rule, and sums over the terms that no rule and no list decided.

    Null terms count as a kept placeholder. surnames (column surname) adds the terms that hold one as a word.
    """
    q = F.coalesce(F.col(query_col), F.lit(EMPTY_QUERY))
    kept = F.col("rule") == "clean"
    total = lambda x: F.coalesce(F.sum(F.when(kept, x)), F.lit(0)).cast("long")
    out = flagged.agg(
        F.count("*").alias("total_analyzed"),
        F.count_if(F.col("rule") == "allowed").alias("in_allow_list"),
        F.count_if(F.col("rule") == "number").alias("contained_numbers"),
        F.count_if(F.col("rule") == "at").alias("contained_at"),
        F.count_if(F.col("rule") == "name").alias("contained_name"),
        F.count_if(kept).alias("kept"),
        total(F.length(q)).alias("sum_chars"),
        total(T.upper_count(q)).alias("sum_uppercase_chars"),
        total(T.word_count(q)).alias("sum_words"),
    )
    out = out.withColumn("removed", F.col("total_analyzed") - F.col("in_allow_list") - F.col("kept"))
    if surnames is not None:
        rows = flagged.where(kept).select(F.monotonically_increasing_id().alias("_row"), F.explode(F.array_distinct(T.tokens(q))).alias("surname"))
        hits = rows.join(surnames.select("surname").distinct(), "surname", "left_semi").agg(F.count_distinct("_row").alias("terms_with_surname"))
        out = out.crossJoin(hits)  # two single rows
    return out


def language_counts(terms: DataFrame, query_col: str, language_col: str, score_col: str | None = None) -> DataFrame:
    """Terms by language, of those longer than 5 characters (and surer than 0.2)."""
    fits = F.length(query_col) > 5
    if score_col:
        fits = fits & (F.col(score_col) > 0.2)
    return terms.where(fits).groupBy(F.col(language_col).alias("language_code")).agg(F.count("*").alias("search_term_count"))


def language_json(counts: DataFrame) -> DataFrame:
    """The counts as one JSON object, keys in order; the text null if there are none."""
    entries = F.array_sort(F.collect_list(F.struct("language_code", "search_term_count")))
    return counts.agg(F.when(F.count("*") > 0, F.to_json(F.map_from_entries(entries))).otherwise(F.lit("null")).alias("languages_json"))


def explode_language_json(rows: DataFrame, json_col: str) -> DataFrame:
    """One row per key of a JSON object of counts; counts that are no numbers become null."""
    pair = rows.select(*[c for c in rows.columns if c != json_col], F.explode(F.from_json(json_col, "map<string,string>")).alias("language_code", "_n"))
    return pair.withColumn("search_term_count", F.expr("try_cast(_n AS bigint)")).drop("_n")
