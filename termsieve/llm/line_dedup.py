"""Site-relative removal of boilerplate lines from web pages, in DataFrame functions alone.

Per host, the pages that hold a line are divided by the host's pages; lines above a ratio are boilerplate. Lines
are counted by a 64-bit hash, once a page. A host has at most (lines per page / ratio) boilerplate lines, so their
hashes fit in one array per host, which the pages of the host are filtered by where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm.runtime import stored

# Patterns start with one character, so that most places are ruled out at once.
HIDDEN = r"(?is)<(?:(?:script|style|noscript|template)\b[^>]*>.*?</(?:script|style|noscript|template)\s*>|!--.*?-->)"
INLINE = r"(?i)</?(?:a|abbr|b|big|cite|code|del|dfn|em|font|i|img|input|ins|kbd|label|mark|q|s|samp|small|span|strong|sub|sup|time|tt|u|var|wbr)(?:[ \t\n\r/][^>]*)?>"
TAG = r"<[^>]*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
BLANKS, RUN = (("\t", " "), ("\x0b", " "), ("\f", " "), ("\r", "\n")), "  +"
MARK = "\n"


@dataclass(frozen=True)
class Settings:
    """ratio: share of its host's pages above which a line is boilerplate, if it is on at least `pages` of them."""

    ratio: float = 0.3
    pages: int = 3


def host(url: Column) -> Column:
    """The host of a URL in lower case; null for null, empty where there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def lines(html: Column) -> Column:
    """The visible lines of a page: tags other than inline ones and line ends separate, blanks are squeezed."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, INLINE, ""), TAG, MARK)
    for old, new in (*ENTITIES, *BLANKS):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(text, RUN, " ")
    return F.filter(F.transform(F.split(text, MARK), lambda x: F.trim(x)), lambda x: x != "")


def without_boilerplate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", settings: Settings | None = None) -> DataFrame:
    """One row per input row: id_col, host, text, n_lines, n_dropped.

    text holds the kept lines, in order and with repeats, joined by line feeds. Null urls are a host of their own
    (null), urls without a host another (''); a null page has no lines. Repeated rows count as pages of their own.
    Other columns are not read; hosts with fewer than settings.pages pages lose nothing.
    """
    s = settings or Settings()
    cut = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), lines(F.col(html_col)).alias("lines"))
    cut = stored(cut, "page-lines")  # the patterns cost more than the table: they run once
    marks = cut.select("host", F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x))).alias("marks"))
    total = marks.groupBy(F.col("host").alias("site")).agg(F.count("*").alias("pages"))
    seen = marks.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= s.pages)
    frequent = stored(seen, "line-counts").join(total, F.col("host").eqNullSafe(F.col("site"))).where(F.col("n") > F.lit(s.ratio) * F.col("pages"))
    boiler = stored(frequent.groupBy("site").agg(F.collect_set("mark").alias("drop")), "boilerplate")
    both = cut.join(boiler, F.col("host").eqNullSafe(F.col("site")), "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("drop", F.xxhash64(x))))
    out = both.select("id", "host", "lines", kept.alias("kept"))
    return out.select(
        F.col("id").alias(id_col), "host", F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )


def _sql(s: Settings) -> str:
    raw = lambda x: "'" + x.replace("'", "''") + "'"
    text = f"regexp_replace(coalesce(html, ''), {raw(HIDDEN)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {raw(INLINE)}, '', 'g'), {raw(TAG)}, chr(10), 'g')"
    for old, new in ENTITIES:
        text = f"replace({text}, {raw(old)}, {raw(new)})"
    for old, new in BLANKS:
        text = f"replace({text}, chr({ord(old)}), chr({ord(new)}))"
    text = f"regexp_replace({text}, {raw(RUN)}, ' ', 'g')"
    return f"""
WITH cut AS (
  SELECT page_id, lower(regexp_extract(url, {raw(HOST)}, 1)) AS host,
         list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l
  FROM pages
), total AS (SELECT host, count(*) AS pages FROM cut GROUP BY host),
seen AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(l)) AS line FROM cut) GROUP BY host, line),
boiler AS (
  SELECT s.host, list(s.line) AS bad FROM seen s JOIN total t ON s.host IS NOT DISTINCT FROM t.host
  WHERE s.n >= {s.pages} AND s.n > {s.ratio}::DOUBLE * t.pages GROUP BY s.host
), kept AS (
  SELECT c.page_id, c.host, c.l, CASE WHEN b.bad IS NULL THEN c.l ELSE list_filter(c.l, lambda x: NOT list_contains(b.bad, x)) END AS k
  FROM cut c LEFT JOIN boiler b ON c.host IS NOT DISTINCT FROM b.host
)
SELECT page_id, host, array_to_string(k, chr(10)) AS text, len(l)::BIGINT AS n_lines, (len(l) - len(k))::BIGINT AS n_dropped FROM kept
"""


ORACLE_SQL = _sql(Settings())
