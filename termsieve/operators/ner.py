"""Name, language and part-of-speech models behind one interface, with a plain fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.functions import text as T
from termsieve.operators.rules import rule


class PersonDetector(Protocol):
    """detect: one row per text with has_person, language, score, confidence (of a person) and has_noun."""

    def detect(self, texts: pd.Series) -> pd.DataFrame: ...


#: Titles, and frequent words by language that are no part of a name.
TITLES = ("mr", "mrs", "ms", "dr", "prof", "sir", "herr", "frau", "señor", "señora", "monsieur", "madame")
STOP_WORDS = {
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "with", "on", "near", "how", "what", "where", "who", "my", "best", "vs", "from", "at"),
    "de": ("der", "die", "und", "das", "ist", "ein", "nicht", "mit", "zu", "den", "wie", "wo", "für", "im", "von", "wer", "was", "auf", "bei", "kaufen"),
    "fr": ("le", "la", "les", "et", "des", "en", "un", "une", "est", "que", "pour", "du", "où", "comment", "avec", "dans", "qui", "sur", "pas", "cher"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "un", "una", "es", "para", "con", "como", "donde", "las", "del", "por", "quien", "mejor", "al"),
}
#: A short list of common forenames, for use without a list of one's own.
FORENAMES = (
    "james", "mary", "robert", "patricia", "john", "jennifer", "michael", "linda", "david", "elizabeth", "william", "barbara",
    "richard", "susan", "joseph", "jessica", "thomas", "sarah", "maria", "anna", "peter", "hans", "klaus", "jürgen", "josé",
    "juan", "carlos", "lucía", "pierre", "jean", "marie", "claire", "emma", "sophie", "paul",
)


#: All frequent words, the beginning of a name's word, and what is taken off a word's ends.
FREQUENT = tuple(sorted({w for v in STOP_WORDS.values() for w in v}))
WORD, EDGES = r"^\p{L}[\p{L}'-]", r"^[^\p{L}]+|[^\p{L}]+$"


def language(text: Column) -> Column:
    """struct(language, score): the language of most of a text's frequent words, and their share of its words.

    Texts without any are English with score 0 (null texts: null), which the report of languages leaves out.
    """
    own = T.words(F.lower(text))

    def count(words: Sequence[str]) -> Column:
        return F.size(F.filter(own, lambda w: w.isin(*words)))

    best = F.array_max(F.array(*[F.struct(count(v).alias("n"), F.lit(k == "en").alias("first"), F.lit(k).alias("language")) for k, v in STOP_WORDS.items()]))
    return F.struct(best["language"].alias("language"), F.try_divide(best["n"].cast("double"), F.size(own).cast("double")).alias("score"))


def gazetteer(text: Column, forenames: Sequence[str] = FORENAMES) -> Column:
    """The answers of a detector, by built-in functions alone: a forename or title before a word that is no frequent one.

    It makes no claim to a trained model's recall; give names_by_lists() lists of forenames, surnames and words for more.
    """
    own = T.words(text)
    rest = F.greatest(F.size(own) - 1, F.lit(0))
    bare = lambda w: F.regexp_replace(F.lower(w), EDGES, "")
    name = lambda w: bare(w).isin(*forenames, *TITLES)
    other = lambda w: w.rlike(WORD) & ~bare(w).isin(*FREQUENT)
    person = F.coalesce(F.exists(F.zip_with(F.slice(own, F.lit(1), rest), F.slice(own, F.lit(2), rest), lambda a, b: name(a) & other(b)), lambda x: x), F.lit(False))
    spoken = language(F.coalesce(text, F.lit("")))
    return F.struct(
        person.alias("has_person"), spoken["language"].alias("language"), F.coalesce(spoken["score"], F.lit(0.0)).alias("score"),
        F.when(person, 0.9).otherwise(0.0).alias("confidence"), F.coalesce(text.rlike(r"(?u)\p{L}{4,}"), F.lit(False)).alias("has_noun"),
    )


def names_by_lists(rows: DataFrame, query_col: str, forenames: DataFrame, surnames: DataFrame, words: DataFrame) -> DataFrame:
    """The rows with person: whether two neighbouring words are a name.

    They are one if the first is a forename and the second a surname or no dictionary word, or if the second is a
    surname that is no dictionary word and the first is a forename or neither a dictionary word nor a frequent one.
    forenames, surnames and words are lists in lower case (columns forename, surname, word) of any size: all
    look-ups are equi-joins of the queries' distinct words. Null and empty queries hold no name; repeated rows stay.
    """
    own = F.filter(F.transform(T.words(F.lower("_q")), lambda w: F.regexp_replace(w, r"(?u)^[^\p{L}]+|('s)?[^\p{L}]*$", "")), lambda w: w != "")
    terms = rows.select(F.col(query_col).alias("_q")).where(F.col(query_col).isNotNull()).distinct().withColumn("_w", own)
    every = terms.select(F.explode("_w").alias("_word")).distinct()
    for name, table, column in (("f", forenames, "forename"), ("s", surnames, "surname"), ("d", words, "word")):
        listed = table.select(F.lower(column).alias("_word")).distinct().withColumn(f"_{name}", F.lit(True))
        every = every.join(listed, "_word", "left").withColumn(f"_{name}", F.coalesce(f"_{name}", F.lit(False)))
    kinds = every.select("_word", F.struct("_f", "_s", (F.col("_d") | F.col("_word").isin(*FREQUENT)).alias("_d"), F.col("_word").isin(*FREQUENT).alias("_o")).alias("_k"))
    placed = terms.select("_q", F.posexplode("_w").alias("_i", "_word")).join(kinds, "_word")
    after = placed.select("_q", (F.col("_i") - 1).alias("_i"), F.col("_k").alias("_n"))
    pair = placed.join(after, ["_q", "_i"])
    second = F.col("_n._s") | ~F.col("_n._d")
    person = (F.col("_k._f") & second & ~F.col("_n._o")) | (F.col("_n._s") & ~F.col("_n._d") & ~F.col("_k._d"))
    hit = pair.where(person).select("_q").distinct().withColumn("person", F.lit(True))
    out = rows.join(hit, F.col(query_col) == F.col("_q"), "left").drop("_q")
    return out.withColumn("person", F.coalesce("person", F.lit(False)))


class SpacyDetector:
    """A spaCy pipeline, if the library and the model are there; it is loaded once a worker."""

    def __init__(self, model: str) -> None:
        self.model = model

    def detect(self, texts: pd.Series) -> pd.DataFrame:
        import spacy

        if not hasattr(self, "_nlp"):
            self._nlp = spacy.load(self.model, exclude=["lemmatizer"])
        rows = []
        for doc in self._nlp.pipe(texts.fillna("").tolist()):
            person = any(e.label_ == "PERSON" and e.text for e in doc.ents)
            spoken = doc._.language if doc.has_extension("language") else None  # a language pipe's answer, if there is one
            score = doc._.language_score if doc.has_extension("language_score") else 0.0
            rows.append((person, spoken, score, 1.0 if person else 0.0, any(t.pos_ == "NOUN" for t in doc)))
        return pd.DataFrame(rows, columns=["has_person", "language", "score", "confidence", "has_noun"])


SCHEMA = "has_person boolean, language string, score double, confidence double, has_noun boolean"


def annotate(detector: PersonDetector | None = None) -> Callable:
    """A function of a text column with the detector's answers as a struct; without a detector the gazetteer's."""
    if detector is None:
        return lambda c: gazetteer(F.col(c) if isinstance(c, str) else c)

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield detector.detect(texts)

    return run


def flag_names(rows: DataFrame, query_col: str, detector: PersonDetector | None = None) -> DataFrame:
    """The rows with rule: number, at or name, else clean. The model sees only rows that no cheap rule decides."""
    ruled = rows.withColumn("rule", rule(F.col(query_col)))
    cheap = ruled.where(F.col("rule").isNotNull())
    model = annotate(detector)
    rest = ruled.where(F.col("rule").isNull()).withColumn("_m", model(F.col(query_col)))
    rest = rest.withColumn("rule", F.when(F.col("_m.has_person"), "name").otherwise("clean")).drop("_m")
    return cheap.unionByName(rest)


def remote_scan(rows: DataFrame, id_col: str, text_col: str, scan: Callable[[list[str]], list[list[tuple[str, str, str]]]], chunk: int = 10_000) -> DataFrame:
    """(id, entities) from a scanner that takes a list of texts: called a chunk at a time, matched by position."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), chunk):
                part = pdf.iloc[a : a + chunk]
                found = scan(part[text_col].fillna("").tolist())
                yield pd.DataFrame({id_col: part[id_col].values, "entities": [[{"type": k, "text": t, "score": s} for k, t, s in r] or None for r in found]})

    kind = dict(rows.dtypes)[id_col]
    return rows.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, entities array<struct<type:string,text:string,score:string>>")
