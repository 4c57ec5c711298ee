"""Text functions on columns, all built-in expressions."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def words(text: Column) -> Column:
    """Words between white space, empty ones left out."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def blank(text: Column) -> Column:
    """Whether a text holds nothing but white space of any kind; null for null."""
    return ~text.rlike(r"(?U)\S")


def tokens(text: Column) -> Column:
    """Lower-cased words without ASCII punctuation; a word of punctuation alone stays as an empty token."""
    return F.transform(words(text), lambda w: F.translate(F.lower(w), string.punctuation, ""))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def upper_count(text: Column) -> Column:
    """ASCII capitals."""
    return F.regexp_count(text, F.lit("[A-Z]")).cast("long")


def lines(text: Column) -> Column:
    """Lines that hold more than white space."""
    return F.filter(F.split(text, "\n"), lambda x: ~blank(x))


def has_digit(text: Column) -> Column:
    """Any of 0-9; digits of other scripts don't count."""
    return text.rlike("[0-9]")


def ngrams(tokens_: Column, up_to: int) -> Column:
    """All runs of 1 to up_to tokens, joined by spaces."""

    def of(t: Column, n: int) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))

    # The array around the tokens binds them: an expression inside the lambda is computed again for every run.
    bound = F.transform(F.array(tokens_), lambda t: F.flatten(F.array(*[of(t, n) for n in range(1, up_to + 1)])))
    return F.element_at(bound, 1)


def prefixes(word: Column) -> Column:
    """All prefixes of a word, the word itself included; none of an empty one."""
    ends = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda n: F.substring(word, F.lit(1), n))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whole-phrase containment between single spaces."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def no_word_characters(text: Column) -> Column:
    """Only non-word characters, at least one of them."""
    return text.rlike(r"(?U)^\W+$")


def rot13(text: Column) -> Column:
    low, up = string.ascii_lowercase, string.ascii_uppercase
    return F.translate(text, low + up, low[13:] + low[:13] + up[13:] + up[:13])


def alternation(patterns: Iterable[str], literal: bool = False, whole_words: bool = False) -> str:
    """One case-insensitive pattern for all; a pattern that matches nothing if there are none."""
    parts = [re.escape(p) if literal else p for p in patterns]
    if not parts:
        return r"(?!)"
    body = "|".join(parts)
    return rf"(?i)\b({body})\b" if whole_words else f"(?i)({body})"


def fill_template(template: Column, name: Column) -> Column:
    return F.replace(template, F.lit("[name]"), name)


def talk_title(title: Column) -> Column:
    """'Namespace talk:Title' as 'Namespace:Title' and 'Talk:Title' as 'Title'."""
    return F.regexp_replace(F.regexp_replace(title, "^([^:]+) talk:", "$1:"), "^Talk:", "")


def null_if_none(value: Column) -> Column:
    return F.nullif(value, F.lit("none"))
