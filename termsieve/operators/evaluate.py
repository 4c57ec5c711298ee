"""Reports on labelled rows: rates, shares, margins and intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsieve.operators.sampling import fraction


def value_counts(rows: DataFrame, cols: Sequence[str], keep_null: bool = True) -> DataFrame:
    kept = rows if keep_null else rows.dropna(subset=list(cols))
    return kept.groupBy(*cols).agg(F.count("*").alias("n"))


def rates(rows: DataFrame, flag: Column, by: Sequence[str]) -> DataFrame:
    """Share of rows with the flag, by group; a null flag counts as no row."""
    return rows.groupBy(*by).agg(F.count(flag).alias("n"), F.avg(flag.cast("int")).alias("rate"))


def group_share(counts: DataFrame, by: Sequence[str], n_col: str = "n") -> DataFrame:
    """Each count's share of its group."""
    return counts.withColumn("share", F.try_divide(F.col(n_col).cast("double"), F.sum(n_col).over(Window.partitionBy(*by))))


def recall_interval(rows: DataFrame, flag: Column, draws: int, size: int, seed: int = 1, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """Percentiles of the recall over repeated samples with replacement.

    A sample of `size` rows has as many flagged ones as `size` draws at the overall rate; so only that rate and the
    draws are computed, and rows are read once.
    """
    rate = rows.agg(F.avg(flag.cast("int")).alias("rate"))
    spark = rows.sparkSession
    one = spark.range(draws * size).withColumns({"draw": F.expr(f"id div {size}"), "u": fraction(F.col("id"), seed)})
    per = one.crossJoin(F.broadcast(rate)).groupBy("draw").agg(F.avg((F.col("u") < F.col("rate")).cast("int")).alias("recall"), F.first("rate").alias("rate"))
    return per.agg(F.first("rate").alias("recall"), F.percentile("recall", F.lit(low)).alias("low"), F.percentile("recall", F.lit(high)).alias("high"))


def contexts(names: DataFrame, name_col: str, templates: DataFrame, template_col: str) -> DataFrame:
    """Every name in every template; templates are a short list that a user gives, repeated ones stay."""
    return names.crossJoin(F.broadcast(templates)).withColumn("query", F.replace(template_col, F.lit("[name]"), name_col))


def recode(code: Column, labels: dict[str, str]) -> Column:
    """The label of a code, 'no' for null; an unmapped code raises."""
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    found = F.element_at(pairs, code)
    return F.when(code.isNull(), "no").when(found.isNull(), F.raise_error(F.concat(F.lit("no label for code "), code))).otherwise(found)


#: Annotation types and whether they count as personal information by themselves.
ANNOTATION_DEFAULTS = {
    "address": True, "phonenumber": True, "idnumber": True, "IPaddress": True, "financial": True, "date": False,
    "measurement": False, "entityname": False, "other": False, "email": True, "username": True, "code": False, "at": False,
}


def annotated_pii(rows: DataFrame, key_cols: Sequence[str], types_col: str, override_col: str) -> DataFrame:
    """is_pii of each row: the annotator's own mark, else whether any of its types counts by default."""
    pairs = F.create_map(*[F.lit(x) for kv in ANNOTATION_DEFAULTS.items() for x in kv])
    default = F.exists(types_col, lambda t: F.coalesce(F.try_element_at(pairs, t), F.lit(False)))
    return rows.select(*key_cols, F.coalesce(override_col, default, F.lit(False)).alias("is_pii"))
