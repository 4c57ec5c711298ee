"""Entity scanners over texts: patterns to arrays of (type, text, score), and reports on their results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pattern and score of each entity type; a type with two levels names the one for unconfirmed hits first.
PATTERNS = {
    "EMAIL": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z][A-Za-z]+", 1.0),
    "IP_ADDRESS": (r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", 0.6),
    "PHONE_NUMBER": (r"[+][0-9]{1,2} [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}", 0.4),
    "CREDIT_CARD": (r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", 0.3),
    "SECRET_TOKEN": (r"[0-9a-f]{40}", 0.8),
    "US_SSN": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.5),
    "IBAN_CODE": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", 0.5),
}
#: What a text must hold for a pattern to be tried on it.
NEEDS = {"EMAIL": "@", "PHONE_NUMBER": "+", "US_SSN": "-"}
CONFIRMED = 1.0
ENTITY = "array<struct<type:string,text:string,score:double>>"


def luhn(number: Column) -> Column:
    """Whether the digits of a number pass the Luhn check."""
    digits = F.reverse(F.filter(F.split(F.regexp_replace(number, "[^0-9]", ""), ""), lambda c: c != ""))
    doubled = F.transform(digits, lambda c, i: F.when(i % 2 == 1, F.expr("1") * c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return (F.size(digits) > 0) & (F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0)


def _entity(kind: str, score: float):
    def make(x: Column) -> Column:
        level = F.when(luhn(x), F.lit(CONFIRMED)).otherwise(F.lit(score)) if kind == "CREDIT_CARD" else F.lit(score)
        return F.struct(F.lit(kind).alias("type"), x.alias("text"), level.alias("score"))

    return make


def scan(text: Column, entities: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> Column:
    """All entities found, types in the order of PATTERNS, or null if there are none; card numbers that pass the
    Luhn check score higher."""
    parts = []
    for kind, (pattern, score) in PATTERNS.items():
        if kind not in exclude and (entities is None or kind in entities):
            found = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), _entity(kind, score))
            parts.append(F.when(text.contains(NEEDS[kind]), found).otherwise(F.array().cast(ENTITY)) if kind in NEEDS else found)
    every = F.flatten(F.array(*parts)) if parts else F.array().cast(ENTITY)
    return F.when(F.size(every) > 0, every)


def without(entities: Column, kinds: Sequence[str]) -> Column:
    """Entities of other types; null if none is left."""
    left = F.filter(entities, lambda e: ~e["type"].isin(list(kinds)))
    return F.when(F.size(left) > 0, left)


def detected(entities: Column, exclude: Sequence[str] = ()) -> Column:
    return F.coalesce(F.exists(entities, lambda e: ~e["type"].isin(list(exclude))), F.lit(False))


def score_bucket(entities: Column, high: float = 0.8, medium: float = 0.4) -> Column:
    """'high', 'med' or 'low' by the best score; null without entities."""
    best = F.array_max(F.transform(entities, lambda e: e["score"]))
    return F.when(best >= high, "high").when(best >= medium, "med").when(best.isNotNull(), "low")


def confusion(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Counts of two scanners' flags against each other, with totals, as one row per value of the first."""
    label = lambda c: F.when(F.grouping(c) == 1, "total").when(F.col(c), "yes").otherwise("no")
    counted = rows.cube(first, second).agg(F.count("*").alias("n"), label(first).alias("first"), label(second).alias("second"))
    pick = lambda v: F.coalesce(F.sum(F.when(F.col("second") == v, F.col("n"))), F.lit(0)).cast("long").alias(f"second_{v}")
    return counted.groupBy("first").agg(pick("yes"), pick("no"), pick("total"))


def by_label(rows: DataFrame, flagged: str, group_col: str, label_col: str) -> DataFrame:
    """Flagged and other rows by group and label, with totals by group and over all ('total')."""
    out = rows.rollup(group_col, label_col).agg(
        F.count_if(F.col(flagged)).alias("n_flagged"), F.count_if(~F.col(flagged)).alias("n_unflagged"),
        F.grouping_id().alias("_g"),
    )
    group = F.when(F.col("_g") == 3, "total").otherwise(F.col(group_col).cast("string"))
    label = F.when(F.col("_g") >= 1, "total").otherwise(F.col(label_col).cast("string"))
    return out.select(group.alias("grouping"), label.alias("label"), "n_flagged", "n_unflagged")
