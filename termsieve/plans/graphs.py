"""Queries over the category graph, pages, and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termsieve.functions import text as T
from termsieve.operators import graph, pages
from termsieve.plans.registry import query, table
from termsieve.scratch import held
from termsieve.sources.readers import parse_statements

#: A category graph out of regions, nations and suppliers: regions hold nations, nations hold suppliers; every
#: supplier whose key is divisible by 10 holds its region again (cycles), and keys divisible by 7 are hidden.
SQL_GRAPH = """
info AS (
  SELECT 'R' || r_regionkey AS key, r_name AS name, false AS hidden, 0::BIGINT AS num_pages, 5::BIGINT AS num_subcats FROM region
  UNION ALL SELECT 'N' || n_nationkey, n_name, false, n_nationkey::BIGINT % 3, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) FROM nation
  UNION ALL SELECT 'S' || s_suppkey, s_name, s_suppkey % 7 = 0, s_suppkey % 4, 0 FROM supplier),
link AS (
  SELECT 'N' || n_nationkey AS key, 'R' || n_regionkey AS parent FROM nation
  UNION ALL SELECT 'N' || n_nationkey, 'X' || n_nationkey FROM nation WHERE n_nationkey % 5 = 0
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier
  UNION ALL SELECT 'S' || s_suppkey, 'N' || (s_nationkey + 1) % 25 FROM supplier WHERE s_suppkey % 3 = 0
  UNION ALL SELECT 'R' || n_regionkey, 'S' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 = 0),
edges AS (SELECT DISTINCT p.name AS parent, c.name AS child, c.key AS child_key, p.key AS parent_key FROM link l JOIN info c ON l.key = c.key JOIN info p ON l.parent = p.key WHERE NOT p.hidden),
down AS (SELECT DISTINCT parent, child FROM edges JOIN info ON info.key = child_key WHERE NOT hidden)
"""


def _info(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r, n, s = (table(spark, d, t) for t in ("region", "nation", "supplier"))
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("key")
    num = lambda c: c.cast("long")
    held = s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("num_subcats"))
    info = r.select(key("R", "r_regionkey"), F.col("r_name").alias("name"), F.lit(False).alias("hidden"), num(F.lit(0)).alias("num_pages"), num(F.lit(5)).alias("num_subcats"))
    info = info.union(n.join(held, "n_nationkey", "left").select(key("N", "n_nationkey"), "n_name", F.lit(False), num(F.col("n_nationkey") % 3), F.coalesce("num_subcats", F.lit(0))))
    info = info.union(s.select(key("S", "s_suppkey"), "s_name", F.col("s_suppkey") % 7 == 0, num(F.col("s_suppkey") % 4), num(F.lit(0))))
    pair = lambda df, a, b: df.select(a, b.alias("parent"))
    p = lambda x, c: F.concat(F.lit(x), c.cast("string"))
    link = pair(n, key("N", "n_nationkey"), p("R", F.col("n_regionkey")))
    link = link.union(pair(n.where("n_nationkey % 5 = 0"), key("N", "n_nationkey"), p("X", F.col("n_nationkey"))))
    link = link.union(pair(s, key("S", "s_suppkey"), p("N", F.col("s_nationkey"))))
    link = link.union(pair(s.where("s_suppkey % 3 = 0"), key("S", "s_suppkey"), p("N", (F.col("s_nationkey") + 1) % 25)))
    back = s.where("s_suppkey % 10 = 0").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    link = link.union(pair(back, key("R", "n_regionkey"), p("S", F.col("s_suppkey"))))
    return info, link.groupBy("key").agg(F.collect_list("parent").alias("parents"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    """The index written out: walks and matches read it several times."""
    return held(graph.category_index(*_info(spark, d)))


@query(f"""WITH {SQL_GRAPH}
SELECT i.key, i.name, i.hidden, i.num_pages, i.num_subcats, (SELECT count(*) FROM link l WHERE l.key = i.key) AS n_parents,
  coalesce((SELECT string_agg(DISTINCT parent, '|' ORDER BY parent) FROM edges e WHERE e.child_key = i.key), '') AS parents_visible,
  coalesce((SELECT string_agg(DISTINCT child, '|' ORDER BY child) FROM down e WHERE e.parent = i.name AND NOT i.hidden), '') AS subcats_visible
FROM info i""")
def category_index(spark: SparkSession, d: str) -> DataFrame:
    out = _index(spark, d)
    join = lambda c: F.array_join(c, "|").alias(c)
    return out.select("key", "name", "hidden", "num_pages", "num_subcats", F.size("parents").cast("long").alias("n_parents"), join("parents_visible"), join("subcats_visible"))


@query(f"WITH {SQL_GRAPH} SELECT count(*) AS n_unknown FROM link WHERE parent NOT IN (SELECT key FROM info)")
def unknown_parents(spark: SparkSession, d: str) -> DataFrame:
    return graph.unknown_parents(*_info(spark, d))


SQL_MATCH = f"""{SQL_GRAPH}, found AS (
  SELECT key, name, CASE WHEN name IN ('ASIA', 'NATION_3') THEN name ELSE regexp_extract(name, '(?i)((0000[0-4]|nation_1)[0-9])', 1) END AS seed FROM info
  WHERE NOT hidden AND (name IN ('ASIA', 'NATION_3') OR regexp_matches(name, '(?i)(0000[0-4]|nation_1)[0-9]')) AND num_pages + num_subcats > 0)"""
NAMES, REGEX = ["ASIA", "NATION_3"], "(0000[0-4]|nation_1)[0-9]"


@query(f"""WITH {SQL_MATCH} SELECT f.key, f.name, f.seed, coalesce(bool_or(e.parent IN (SELECT name FROM found)), false) AS has_parent_in_list
FROM found f LEFT JOIN edges e ON e.child_key = f.key GROUP BY f.key, f.name, f.seed""")
def category_match(spark: SparkSession, d: str) -> DataFrame:
    return graph.match(_index(spark, d), NAMES, REGEX).select("key", "name", "seed", "has_parent_in_list")


@query(f"""WITH {SQL_MATCH} SELECT DISTINCT f.key, f.name, e.parent, coalesce(e.parent IN (SELECT name FROM found), false) AS parent_in_list
FROM found f LEFT JOIN edges e ON e.child_key = f.key""")
def parents_flag(spark: SparkSession, d: str) -> DataFrame:
    return graph.parents_flag(graph.match(_index(spark, d), NAMES, REGEX))


def _walk_sql(seeds: str, cut: str = "true", top: int = 100) -> str:
    """Levels first, by a search that ends with the graph's diameter; then seed and parent of each name's level."""
    return f"""
seeds AS ({seeds}),
walk AS (SELECT name, seed, ''::VARCHAR AS parent, 0 AS level FROM seeds WHERE {cut.replace('@@', 'name')}
  UNION SELECT d.child, w.seed, w.name, w.level + 1 FROM walk w JOIN down d ON d.parent = w.name WHERE w.level < least({top}, 40) AND {cut.replace('@@', 'd.child')}),
low AS (SELECT name, min(level) AS level FROM walk GROUP BY name),
reach AS (SELECT s.name, s.seed, ''::VARCHAR AS parent, 0 AS level FROM (SELECT name, min(seed) AS seed FROM seeds WHERE {cut.replace('@@', 'name')} GROUP BY name) s
  UNION ALL SELECT x.child, x.seed, x.parent, x.level FROM (SELECT d.child, r.seed, r.name AS parent, r.level + 1 AS level, row_number() OVER (PARTITION BY d.child ORDER BY r.seed, r.name) AS k
    FROM reach r JOIN down d ON d.parent = r.name JOIN low l ON l.name = d.child AND l.level = r.level + 1) x WHERE x.k = 1)"""


ROWS = "name, seed, nullif(parent, '') AS parent, level::BIGINT AS level"


@query(f"WITH RECURSIVE {SQL_GRAPH}, {_walk_sql(chr(39).join(['SELECT name, name AS seed FROM info WHERE name IN (', 'ASIA', ', ', 'NATION_3', ')']))} SELECT {ROWS} FROM reach")
def category_bfs(spark: SparkSession, d: str) -> DataFrame:
    index = _index(spark, d)
    return graph.walk(index, graph.match(index, NAMES).select("name", "seed"))


@query(f"""WITH RECURSIVE {SQL_GRAPH}, {_walk_sql("SELECT name, name AS seed FROM info WHERE name IN ('ASIA', 'EUROPE')", "(@@ <> 'NATION_7' AND NOT regexp_matches(@@, '(?i)supplier#0000000[0-2]'))", 2)} SELECT {ROWS} FROM reach""")
def category_bfs_excluded(spark: SparkSession, d: str) -> DataFrame:
    index = _index(spark, d)
    return graph.walk(index, graph.match(index, ["ASIA", "EUROPE"]).select("name", "seed"), ["NATION_7"], "supplier#0000000[0-2]", 2)


TOPICS = graph.Seeds((graph.Topic("one", ["ASIA"], max_level=1), graph.Topic("two", ["ASIA", "AFRICA"], max_level=1), graph.Topic("three", (), ["nation_2"], ["NATION_20"], max_level=1)))


def _topic_sql(k: int, name: str, seeds: str, cut: str) -> str:
    return f"""s{k} AS ({seeds}), t{k} AS (SELECT name, '{name}' AS topic, {k} AS k, seed, NULL::VARCHAR AS parent, 0 AS level FROM s{k} WHERE {cut.replace('@@', 'name')}
UNION ALL SELECT child, '{name}', {k}, seed, parent, 1 FROM (SELECT d.child, s.seed, s.name AS parent, row_number() OVER (PARTITION BY d.child ORDER BY s.seed, s.name) AS n
  FROM s{k} s JOIN down d ON d.parent = s.name WHERE {cut.replace('@@', 's.name')} AND {cut.replace('@@', 'd.child')} AND d.child NOT IN (SELECT name FROM s{k} WHERE {cut.replace('@@', 'name')})) WHERE n = 1)"""


@query(f"""WITH {SQL_GRAPH}, {_topic_sql(0, 'one', "SELECT name, name AS seed FROM info WHERE name = 'ASIA'", 'true')},
{_topic_sql(1, 'two', "SELECT name, name AS seed FROM info WHERE name IN ('ASIA', 'AFRICA')", 'true')},
{_topic_sql(2, 'three', "SELECT name, regexp_extract(name, '(?i)(nation_2)', 1) AS seed FROM info WHERE regexp_matches(name, '(?i)nation_2') AND NOT hidden AND num_pages + num_subcats > 0", "@@ <> 'NATION_20'")},
every AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2)
SELECT name, seed, parent, level::BIGINT AS level, topic FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY k) AS n FROM every) WHERE n = 1""")
def topic_list_all(spark: SparkSession, d: str) -> DataFrame:
    return graph.full_list(_index(spark, d), TOPICS)


SQL_LISTS = """prev AS (SELECT n_name AS name, 'topic' || n_regionkey % 2 AS topic, 'seed' || n_regionkey AS seed, NULL::VARCHAR AS parent, 1 AS level FROM nation WHERE n_nationkey < 18),
new AS (SELECT n_name AS name, 'topic' || (CASE WHEN n_nationkey % 6 = 0 THEN n_regionkey + 1 ELSE n_regionkey END) % 2 AS topic, 'seed' || n_regionkey AS seed,
  CASE WHEN n_nationkey % 4 = 0 THEN 'p' END AS parent, 1 AS level FROM nation WHERE n_nationkey > 3)"""


@query(f"""WITH {SQL_LISTS}, j AS (SELECT coalesce(p.name, n.name) AS name, coalesce(p.topic, n.topic) AS topic, p.name IS NULL AS no_p, n.name IS NULL AS no_n,
  CASE WHEN p.name IS NULL THEN '--' ELSE p.seed END AS seed_previous, CASE WHEN p.name IS NULL THEN '--' ELSE coalesce(p.parent, '') END AS parent_previous,
  CASE WHEN p.name IS NULL THEN '--' ELSE p.level::VARCHAR END AS level_previous, CASE WHEN n.name IS NULL THEN '--' ELSE n.seed END AS seed_new,
  CASE WHEN n.name IS NULL THEN '--' ELSE coalesce(n.parent, '') END AS parent_new, CASE WHEN n.name IS NULL THEN '--' ELSE n.level::VARCHAR END AS level_new
  FROM prev p FULL JOIN new n ON p.name = n.name AND p.topic = n.topic)
SELECT name, topic, seed_previous, parent_previous, level_previous, seed_new, parent_new, level_new, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN 'moved' WHEN no_p THEN 'added'
  WHEN no_n THEN 'removed' WHEN seed_previous <> seed_new OR parent_previous <> parent_new OR level_previous <> level_new THEN 'changed' ELSE '' END AS diff FROM j
QUALIFY seed_previous <> seed_new OR parent_previous <> parent_new OR level_previous <> level_new""")
def category_diff(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")

    def rows(df: DataFrame, region, parent) -> DataFrame:
        return df.select(F.col("n_name").alias("name"), F.concat(F.lit("topic"), region % 2).alias("topic"), F.concat(F.lit("seed"), F.col("n_regionkey")).alias("seed"), parent.alias("parent"), F.lit(1).alias("level"))

    r = F.col("n_regionkey")
    prev = rows(n.where("n_nationkey < 18"), r, F.lit(None).cast("string"))
    new = rows(n.where("n_nationkey > 3"), F.when(F.col("n_nationkey") % 6 == 0, r + 1).otherwise(r), F.when(F.col("n_nationkey") % 4 == 0, "p"))
    return graph.compare(prev, new)


@query(f"""WITH {SQL_GRAPH}, k AS (SELECT i.key, NOT EXISTS (SELECT 1 FROM edges e WHERE e.child_key = i.key) AS src, NOT EXISTS (SELECT 1 FROM down e WHERE e.parent = i.name) AS snk FROM info i WHERE NOT hidden)
SELECT count(*) FILTER (src) AS n_sources, count(*) FILTER (snk) AS n_sinks, count(*) FILTER (src AND snk) AS n_isolated, count(*) AS n_visible FROM k""")
def graph_stats(spark: SparkSession, d: str) -> DataFrame:
    return graph.node_kinds(_index(spark, d))


@query(f"""WITH RECURSIVE {SQL_GRAPH}, {_walk_sql("SELECT name, name AS seed FROM info WHERE name IN ('ASIA')")},
m AS (SELECT DISTINCT c_custkey AS page, n_name AS category FROM customer JOIN nation ON c_nationkey = n_nationkey UNION SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT page, string_agg(category, '|' ORDER BY category) AS categories FROM m WHERE category IN (SELECT name FROM reach) GROUP BY page""")
def crawl_members(spark: SparkSession, d: str) -> DataFrame:
    index = _index(spark, d)
    walked = graph.walk(index, graph.match(index, ["ASIA"]).select("name", "seed"))
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    held = c.select(F.col("c_custkey").alias("page"), F.explode(F.array("n_name", "r_name")).alias("category"))
    return graph.members(walked, held).withColumn("categories", F.array_join("categories", "|"))


#: Pages with the link texts of their navigation as categories, and words of part names and frequent ones as list.
SQL_PAGES = r"""p AS (SELECT page_id, url, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract_all(html, '<a href="/([^"]*)">', 1) AS category FROM pages),
blocklist AS (SELECT unnest(['the', 'and', 'der', 'de', 'que', 'of']) AS name)"""


def _pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    h = F.col("html")
    p = table(spark, d, "pages").select("page_id", "url", "html", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract_all(h, F.lit('<a href="/([^"]*)">'), F.lit(1)).alias("category"))
    return p, spark.createDataFrame([(w,) for w in ("the", "and", "der", "de", "que", "of")], "name string")


@query(f"WITH {SQL_PAGES} SELECT page_id, title FROM p WHERE len(list_intersect(category, (SELECT list(name) FROM blocklist))) > 0")
def blocked_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.blocked(*_pages(spark, d)).select("page_id", "title")


@query(f"""WITH {SQL_PAGES}, e AS (SELECT DISTINCT page_id, unnest(category) AS name FROM p)
SELECT page_id, string_agg(name, '|' ORDER BY name) AS blocked FROM e WHERE name IN (SELECT name FROM blocklist) GROUP BY page_id""")
def blocked_categories(spark: SparkSession, d: str) -> DataFrame:
    return pages.blocked_categories(*_pages(spark, d)).withColumn("blocked", F.array_join("blocked", "|"))


@query(f"""WITH {SQL_PAGES} SELECT page_id, list_contains(category, 'the') AS in_the, len(category) AS n_categories, len(list_filter(category, lambda c: starts_with(c, 'th'))) AS n_th,
  title IN (SELECT title FROM p WHERE page_id % 3 = 0) AS listed, contains(html, 'thing') OR contains(html, 'ungen') OR contains(html, '&middot; Da') AS holds FROM p""")
def page_flags(spark: SparkSession, d: str) -> DataFrame:
    p, _ = _pages(spark, d)
    flagged = pages.title_flags(p, "title", {"listed": p.where("page_id % 3 = 0").select("title")})
    needles = spark.createDataFrame([("thing",), ("ungen",), ("&middot; Da",)], "needle string")
    hit = pages.holding_any(p, "html", needles).select(F.col("page_id").alias("_hit"))
    out = flagged.join(hit, F.col("page_id") == F.col("_hit"), "left")
    return out.select("page_id", F.array_contains("category", "the").alias("in_the"), F.size("category").cast("long").alias("n_categories"),
                      F.size(F.filter("category", lambda c: c.startswith("th"))).cast("long").alias("n_th"), "listed", F.col("_hit").isNotNull().alias("holds"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(CASE WHEN page_id % 2 = 0 THEN 'Help talk:' ELSE 'Talk:' END || t, '^([^:]+) talk:', '\1:'), '^Talk:', '') AS title,
  substr(t, 3, 5) AS part, regexp_replace(url, '[?#].*$', '') AS address, trim(split_part(url, '//', 2), ' ') AS rest, page_id || ' ' || t AS joined
FROM (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)""")
def title_rewrite(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("t"))
    kind = F.when(F.col("page_id") % 2 == 0, "Help talk:").otherwise("Talk:")
    return p.select("page_id", T.talk_title(F.concat(kind, "t")).alias("title"), F.substring("t", 3, 5).alias("part"), F.regexp_replace("url", "[?#].*$", "").alias("address"),
                    F.trim(F.split_part("url", F.lit("//"), F.lit(2))).alias("rest"), F.concat_ws(" ", F.col("page_id").cast("string"), "t").alias("joined"))


@query(f"WITH {SQL_GRAPH} SELECT key, name, hidden, num_pages, num_subcats, (SELECT count(*) FROM link l WHERE l.key = info.key) AS n_parents FROM info")
def statement_parse(spark: SparkSession, d: str) -> DataFrame:
    """The graph written as statements and parsed again."""
    info, link = _info(spark, d)
    ref = lambda c: F.concat(F.lit("<https://example.org/Category:"), c, F.lit(">"))
    about = info.select(F.concat(ref(F.col("key")), F.lit(" rdf:type "), F.when(F.col("hidden"), ":HiddenCategory").otherwise(":Category"), F.lit(' ; rdfs:label "'), "name", F.lit('" ; :pages "'), "num_pages", F.lit('" ; :subcategories "'), "num_subcats", F.lit('"')).alias("statement"))
    held = link.select(F.concat(ref(F.col("key")), F.lit(" :isInCategory "), F.array_join(F.transform("parents", ref), ", ")).alias("statement"))
    a, b = parse_statements(about.union(held))
    out = a.join(b, "key", "left")
    return out.select("key", "name", "hidden", "num_pages", "num_subcats", F.coalesce(F.size("parents"), F.lit(0)).cast("long").alias("n_parents"))


@query("""SELECT event_type, (SELECT max(c) FROM (SELECT count(*) AS c FROM events e WHERE e.event_type = o.event_type GROUP BY user_id)) AS most, count(*) AS n,
  count(*) FILTER (user_id % 2 = 0) AS even, count(*) FILTER (user_id % 2 = 1) AS odd FROM events o GROUP BY event_type""")
def type_pivot(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("half", F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"))
    per = e.groupBy("event_type", "user_id").agg(F.count("*").alias("c")).groupBy("event_type").agg(F.max("c").alias("most"), F.sum("c").alias("n"))
    wide = e.groupBy("event_type").pivot("half", ["even", "odd"]).count().na.fill(0, ["even", "odd"])
    return per.join(wide, "event_type")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    first = F.min_by(F.struct("event_id", "user_id", "event_type"), F.struct("ts", "event_id")).alias("r")
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(first).select("r.*")


@query("""SELECT d.doc_id, d.lang, l.quality, l.toxic, length(d.text) = d.n_chars AS same FROM documents d JOIN labels l USING (doc_id) WHERE d.lang IN ('en', 'de') AND l.quality IS NOT NULL""")
def label_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where(F.col("lang").isin("en", "de"))
    return rows.join(table(spark, d, "labels").where("quality IS NOT NULL"), "doc_id").select("doc_id", "lang", "quality", "toxic", (F.length("text") == F.col("n_chars")).alias("same"))


@query("""WITH c AS (SELECT c_nationkey, count(*) AS n, count(DISTINCT c_mktsegment) AS n_segments, min(c_acctbal) AS least FROM customer GROUP BY 1)
SELECT n.n_name, coalesce(c.n, 0) AS n, coalesce(c.n_segments, 0) AS n_segments, c.least, round(coalesce(c.n, 0) / (SELECT count(*) FROM customer), 6) AS share FROM nation n LEFT JOIN c ON n.n_nationkey = c.c_nationkey""")
def category_enrichment(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("n_segments"), F.min("c_acctbal").alias("least"))
    total = table(spark, d, "customer").agg(F.count("*").alias("_all"))
    out = table(spark, d, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").crossJoin(F.broadcast(total))  # one row
    zero = lambda x: F.coalesce(x, F.lit(0))
    return out.select("n_name", zero("n").alias("n"), zero("n_segments").alias("n_segments"), "least", F.round(zero("n") / F.col("_all"), 6).alias("share"))


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice, place, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 6) AS share
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders) WHERE place < 25""")
def ordered_reports(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    top = table(spark, d, "orders").withColumn("place", F.row_number().over(order).cast("long") - 1).where("place < 25")
    share = F.round(F.col("o_totalprice") / F.sum("o_totalprice").over(Window.partitionBy("o_orderpriority")), 6)
    return top.select("o_orderpriority", "o_orderkey", "o_totalprice", "place", share.alias("share")).orderBy("o_orderpriority", "place")
