"""Where the library's queries register themselves, and what their plans and SQL share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.functions import text as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the same in SQL if that can express it."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


#: Tables of long texts, where the work on a row outweighs moving it.
LONG_TEXTS = ("documents", "pages")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table; one of long texts in fewer partitions than there are cores is dealt out over them first.

    That concerns a few small files only: larger tables are read in more partitions and aren't shuffled.
    """
    rows = spark.read.parquet(f"{d}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in LONG_TEXTS and rows._jdf.queryExecution().executedPlan().outputPartitioning().numPartitions() < cores:
        return rows.repartition(cores)
    return rows


PUNCT = string.punctuation.replace("'", "''")


def sql_words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '\s+'), lambda x: x <> '')"


def sql_tokens(text: str) -> str:
    return f"list_transform({sql_words(text)}, lambda w: translate(lower(w), '{PUNCT}', ''))"


def sql_lines(text: str) -> str:
    return f"list_filter(string_split({text}, chr(10)), lambda x: regexp_matches(x, '\\S'))"


def document_words(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, lang, query): every word of the documents, and the words with an @ once more without digits."""
    docs = table(spark, d, "documents")
    w = docs.select("doc_id", "lang", F.explode(T.words(F.col("text"))).alias("query"))
    return w.union(w.where(F.col("query").contains("@")).withColumn("query", F.translate("query", "0123456789", "")))


SQL_DOCUMENT_WORDS = f"""
w AS (SELECT doc_id, lang, unnest({sql_words('text')}) AS query FROM documents),
words AS (SELECT * FROM w UNION ALL SELECT doc_id, lang, translate(query, '0123456789', '') FROM w WHERE contains(query, '@'))
"""


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, lang, line_no, query): the lines of the documents that aren't blank."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", "lang", F.posexplode(T.lines(F.col("text"))).alias("line_no", "query"))


SQL_DOCUMENT_LINES = f"""
lines AS (SELECT doc_id, lang, unnest({sql_lines('text')}) AS query, unnest(range(len({sql_lines('text')}))) AS line_no FROM documents)
"""


def benchmark_words(spark: SparkSession, d: str) -> DataFrame:
    """(word): the distinct words of the benchmark, as an allow-list."""
    return table(spark, d, "benchmark").select(F.explode(T.words(F.col("text"))).alias("word")).distinct()


SQL_ALLOWED = f"allowed AS (SELECT DISTINCT unnest({sql_words('text')}) AS word FROM benchmark)"


def part_words(spark: SparkSession, d: str) -> DataFrame:
    """(word): the distinct lower-case words of part names, and of the benchmark's tokens, as a dictionary."""
    parts = table(spark, d, "part").select(F.explode(T.tokens(F.col("p_name"))).alias("word"))
    bench = table(spark, d, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("word"))
    return parts.union(bench).where("word <> ''").distinct()


SQL_DICTIONARY = f"""
dictionary AS (SELECT DISTINCT word FROM (
  SELECT unnest({sql_tokens('p_name')}) AS word FROM part UNION ALL SELECT unnest({sql_tokens('text')}) FROM benchmark) WHERE word <> '')
"""
