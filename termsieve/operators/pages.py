"""Page records against block-lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocked(pages: DataFrame, blocklist: DataFrame, id_col: str = "page_id", categories_col: str = "category") -> DataFrame:
    """Pages with a category on the list (column name)."""
    rows = pages.select(F.col(id_col).alias("_id"), F.explode(categories_col).alias("name"))
    hit = rows.join(blocklist.select("name").distinct(), "name", "left_semi").select("_id").distinct()
    return pages.join(hit, F.col(id_col) == F.col("_id"), "left_semi")


def blocked_categories(pages: DataFrame, blocklist: DataFrame, id_col: str = "page_id", categories_col: str = "category") -> DataFrame:
    """(id, blocked): the listed categories of each page that has any, in order."""
    rows = pages.select(F.col(id_col), F.explode(F.array_distinct(categories_col)).alias("name"))
    hit = rows.join(blocklist.select("name").distinct(), "name", "left_semi")
    return hit.groupBy(id_col).agg(F.array_sort(F.collect_list("name")).alias("blocked"))


def holding_any(pages: DataFrame, text_col: str, needles: DataFrame, needle_col: str = "needle", most: int = 1000) -> DataFrame:
    """Pages whose text holds one of the needles as a substring; null needles and texts match nothing, '' every text.

    Up to `most` needles are literals of the plan. Of longer lists each needle is looked up by its beginning, an
    equi-join with the texts' runs of as many characters as the shortest needle has (12 at most), and confirmed.
    """
    own = needles.select(F.col(needle_col).alias("_needle")).where("_needle IS NOT NULL").distinct()
    short = own.limit(most + 1).collect()  # `most` + 1 rows
    if len(short) <= most:
        test = F.lit(False)
        for i in range(0, len(short), 200):
            some = F.array(*[F.lit(r[0]) for r in short[i : i + 200]])
            test = test | F.exists(some, lambda n: F.contains(F.col(text_col), n))
        return pages.where(test)
    size = min(12, own.agg(F.min(F.length("_needle"))).first()[0])
    if not size:
        return pages.where(F.col(text_col).isNotNull())
    cols = pages.columns
    keyed = pages.withColumns({"_k1": F.xxhash64(*cols), "_k2": F.xxhash64(F.lit(1), *cols)})
    starts = F.when(F.length(text_col) >= size, F.sequence(F.lit(1), F.length(text_col) - size + 1)).otherwise(F.array().cast("array<int>"))
    runs = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text_col), i, F.lit(size))))
    begun = keyed.select("_k1", "_k2", F.explode(runs).alias("_run")).join(own.withColumn("_run", F.substring("_needle", 1, size)), "_run")
    maybe = begun.select("_k1", "_k2", "_needle").distinct()
    hit = keyed.select("_k1", "_k2", F.col(text_col).alias("_text")).distinct().join(maybe, ["_k1", "_k2"]).where(F.contains("_text", "_needle"))
    return keyed.join(hit.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_semi").select(*cols)


def title_flags(pages: DataFrame, title_col: str, lists: dict[str, DataFrame]) -> DataFrame:
    """A boolean column per list (column title): whether the page's title is on it."""
    for name, df in lists.items():
        listed = df.select(F.col("title").alias("_t")).distinct().withColumn(name, F.lit(True))
        pages = pages.join(listed, F.col(title_col) == F.col("_t"), "left").drop("_t").withColumn(name, F.coalesce(name, F.lit(False)))
    return pages


def reduced(records: DataFrame) -> DataFrame:
    """The fields of a record that later steps need; missing lists are empty, templates keep their namespace."""
    nothing = F.array().cast("array<string>")
    return records.select(
        "page_id", "title", F.coalesce("opening_text", F.lit("")).alias("opening_text"), F.coalesce("category", nothing).alias("category"),
        F.filter(F.coalesce("template", nothing), lambda t: t.startswith("Template:")).alias("template"))
