"""Membership and prefix look-ups of words in dictionaries; prefix joins are equi-joins on exploded prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsieve.functions import text as T


def exploded(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, word) for every token of each text; tokens of punctuation alone are empty words."""
    return rows.select(F.col(id_col).alias("id"), F.posexplode(T.tokens(F.col(text_col))).alias("pos", "word"))


def _ids(words: DataFrame) -> DataFrame:
    return words.select("id").distinct()


def contains_member(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids with a word in the dictionary (column word)."""
    return _ids(words.join(dictionary.select("word").distinct(), "word", "left_semi"))


def contains_nonmember(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids with a word that is not in the dictionary; an empty token isn't."""
    return _ids(words.join(dictionary.select("word").distinct(), "word", "left_anti"))


def dictionary_prefixes(dictionary: DataFrame) -> DataFrame:
    """(prefix, word) for all prefixes of the dictionary's distinct words."""
    return dictionary.select("word").distinct().select(F.explode(T.prefixes(F.col("word"))).alias("prefix"), "word")


def prefix_counts(strings: DataFrame, dictionary: DataFrame, string_col: str = "word", matched: bool = False) -> DataFrame:
    """For every row: n_prefixed (dictionary words that start with it), in_dictionary, and the words if asked for.

    Equal strings keep a row each; the empty string is a prefix of every word.
    """
    aggs = [F.count("*").alias("_n"), F.max(F.col("prefix") == F.col("word")).alias("_in")]
    if matched:
        aggs.append(F.array_sort(F.collect_list("word")).alias("_words"))
    per = dictionary_prefixes(dictionary).groupBy("prefix").agg(*aggs)
    every = dictionary.select("word").distinct().agg(F.count("*").alias("_all")).crossJoin(strings.sparkSession.range(1).drop("id"))
    out = strings.join(per, F.col(string_col) == F.col("prefix"), "left").crossJoin(F.broadcast(every))  # one row
    empty = F.col(string_col) == ""
    cols = [
        F.when(empty, F.col("_all")).otherwise(F.coalesce("_n", F.lit(0))).cast("long").alias("n_prefixed"),
        F.coalesce("_in", F.lit(False)).alias("in_dictionary"),
    ]
    if matched:
        cols.append(F.coalesce("_words", F.array().cast("array<string>")).alias("superstrings"))
    return out.select(*strings.columns, *cols)


def contains_member_prefix(words: DataFrame, surnames: DataFrame, dictionary: DataFrame, fewer_than: int = 5) -> DataFrame:
    """Ids with a surname that starts fewer than so many dictionary words."""
    few = prefix_counts(surnames.select("word").distinct(), dictionary).where(F.col("n_prefixed") < fewer_than)
    return contains_member(words, few.select("word"))


def contains_nonprefix(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids with a word that starts no dictionary word; an empty token starts all."""
    starts = dictionary_prefixes(dictionary).select(F.col("prefix").alias("word")).distinct()
    return _ids(words.where("word <> ''").join(starts, "word", "left_anti"))
