"""Keyphrases in texts: counts, samples, misspellings and similar phrases."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsieve.functions import text as T


def matching(texts: DataFrame, text_col: str, phrases: DataFrame) -> DataFrame:
    """Texts that hold a phrase (column phrase) between spaces: an equi-join of the texts' n-grams with the phrases.

    n-grams go up to the longest phrase, which is read first.
    """
    longest = phrases.agg(F.max(F.size(F.split("phrase", " ")))).first()[0] or 1
    cols = texts.columns  # a row is known by its content, which stays the same wherever it is computed
    keyed = texts.withColumns({"_k1": F.xxhash64(*cols), "_k2": F.xxhash64(F.lit(1), *cols)})
    grams = keyed.select("_k1", "_k2", F.explode(F.array_distinct(T.ngrams(F.split(text_col, " "), longest))).alias("phrase"))
    hit = grams.join(phrases.select("phrase").distinct(), "phrase", "left_semi").select("_k1", "_k2").distinct()
    return keyed.join(hit, ["_k1", "_k2"], "left_semi").select(*cols)


def keyphrase_count(texts: DataFrame, text_col: str, phrases: DataFrame) -> DataFrame:
    return matching(texts, text_col, phrases).agg(F.count("*").alias("n_texts"))


def samples(texts: DataFrame, text_col: str, phrases: DataFrame, n: int, order: Column) -> DataFrame:
    """n matching texts, chosen by the order's hash and sorted; all if there are fewer."""
    return matching(texts, text_col, phrases).orderBy(order).limit(n).orderBy(text_col)


def ngram_counts(texts: DataFrame, text_col: str, up_to: int = 3) -> DataFrame:
    """(phrase, n) of all n-grams of the texts' tokens."""
    return texts.select(F.explode(T.ngrams(T.tokens(F.col(text_col)), up_to)).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n"))


def _runs(text: Column, length: Column, n: int) -> Column:
    """All runs of n characters of a text; the text itself if it is shorter."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), length - n + 1)), lambda i: F.substring(text, i, F.lit(n)))


def misspellings(counts: DataFrame, keyphrases: DataFrame, max_distance: int) -> DataFrame:
    """Counted phrases within an edit distance of a keyphrase.

    Candidates share one of max_distance + 1 pieces of the keyphrase: an equi-join instead of all pairs. Keyphrases
    shorter than that many characters are joined by length instead. Phrases of a length that no keyphrase can come to
    are out before they are cut up; the keyphrases' lengths, from a list that a user gives, go into the plan.
    """
    k = max_distance + 1
    key = keyphrases.select(F.col("phrase").alias("keyphrase")).distinct().withColumn("_n", F.length("keyphrase"))
    cut = key.where(F.col("_n") >= k).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.expr(f"_i * _n div {k}")
    cut = cut.withColumns({"_at": start.cast("int"), "_len": (F.expr(f"(_i + 1) * _n div {k}") - start).cast("int")})
    cut = cut.select("keyphrase", "_n", F.substring("keyphrase", F.col("_at") + 1, F.col("_len")).alias("_piece"), "_at", "_len")
    lens = [r[0] for r in cut.select("_len").distinct().collect()]
    near_to = lambda n: range(max(0, n - max_distance), n + max_distance + 1)
    allowed = sorted({m for r in key.select("_n").distinct().collect() for m in near_to(r[0])})
    rows = counts.withColumn("_m", F.length("phrase")).where(F.col("_m").isin(allowed))
    pieces = F.array(*[_runs(F.col("phrase"), F.col("_m"), n) for n in lens]) if lens else F.array().cast("array<array<string>>")
    grams = rows.select("phrase", "n", "_m", F.explode(F.array_distinct(F.flatten(pieces))).alias("_piece"))
    long = grams.join(cut.select("keyphrase", "_n", "_piece").distinct(), "_piece").select("phrase", "n", "_m", "keyphrase", "_n")
    lengths = key.where(F.col("_n") < k).withColumn("_m", F.explode(F.sequence(F.greatest(F.lit(0), F.col("_n") - max_distance), F.col("_n") + max_distance)))
    short = rows.join(lengths, "_m").select("phrase", "n", "_m", "keyphrase", "_n")
    near = long.union(short).where(F.abs(F.col("_m") - F.col("_n")) <= max_distance).distinct()
    return near.where(F.levenshtein("phrase", "keyphrase", max_distance) >= 0).select("keyphrase", "phrase", "n", F.levenshtein("phrase", "keyphrase").cast("long").alias("distance"))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def context_similarity(occurrences: DataFrame) -> DataFrame:
    """(phrase, score): mean context similarity of its occurrences times the phrase's own weight."""
    return occurrences.groupBy("phrase").agg((F.first("weight") * F.avg("context")).alias("score"))


def at_least_own(rows: DataFrame, group_col: str, phrase_col: str, score_col: str) -> DataFrame:
    """Phrases of a group that score at least as high as the group's own word; all of them if it is not among them."""
    own = F.max(F.when(F.col(phrase_col) == F.col(group_col), F.col(score_col))).over(Window.partitionBy(group_col))
    return rows.withColumn("_own", own).where(F.col("_own").isNull() | (F.col(score_col) >= F.col("_own"))).drop("_own")


def disjoint(rows: DataFrame, group_col: str, phrase_col: str, score_col: str) -> DataFrame:
    """Per group, from the best score down, phrases that neither hold nor are held by one already taken, and the
    group's own word. Groups are parts of a list that was cut to a top n before.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: list[str] = []
        keep = []
        for p in pdf.sort_values([score_col, phrase_col], ascending=[False, True])[phrase_col]:
            if not any(p in t or t in p for t in taken):
                taken.append(p)
                keep.append(p)
        return pdf[pdf[phrase_col].isin(keep) | (pdf[phrase_col] == pdf[group_col])]

    return rows.groupBy(group_col).applyInPandas(pick, rows.schema)


def similar_phrases(candidates: DataFrame, keyphrases: DataFrame, n: int, stop_words: list[str], dictionary: DataFrame | None = None) -> DataFrame:
    """The n candidates (phrase, vector) nearest to any keyphrase (phrase, vector) by cosine.

    Phrases that hold a keyphrase or are made of stop words only are left out before the cut, those with a word
    outside the dictionary after it. Keyphrases are a short list that a user gives.
    """
    keys = keyphrases.select(F.col("phrase").alias("_key"), F.col("vector").alias("_v"))
    stop = F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")
    some = candidates.where(F.size(F.array_except(F.split("phrase", " "), stop)) > 0)
    scored = some.join(F.broadcast(keys) if keys.count() <= 10_000 else keys, F.lit(True)).groupBy("phrase").agg(
        F.max(cosine(F.col("vector"), F.col("_v"))).alias("similarity"), F.max(F.contains("phrase", "_key")).alias("_holds"))
    top = scored.where("not _holds").drop("_holds").orderBy(F.desc("similarity"), "phrase").limit(n)
    if dictionary is None:
        return top
    bad = top.select("phrase", F.explode(F.split("phrase", " ")).alias("word")).join(dictionary.select("word").distinct(), "word", "left_anti")
    return top.join(bad.select("phrase").distinct(), "phrase", "left_anti")
