"""Queries over words, phrases, sessions, entities and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.functions import text as T
from termsieve.operators import dictionary, evaluate, phrases, sampling, scanners, sessions
from termsieve.plans.registry import SQL_DICTIONARY, SQL_DOCUMENT_LINES, document_lines, part_words, query, sql_tokens, sql_words, table

TOKENS = f"tokens AS (SELECT doc_id AS id, unnest({sql_tokens('text')}) AS word FROM documents)"


def _words(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.exploded(table(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {TOKENS}, {SQL_DICTIONARY} SELECT DISTINCT id FROM tokens WHERE word NOT IN (SELECT word FROM dictionary)")
def dict_nonmember(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.contains_nonmember(_words(spark, d), part_words(spark, d))


@query(f"""
WITH {TOKENS}, {SQL_DICTIONARY}, s AS (SELECT DISTINCT word FROM tokens WHERE length(word) BETWEEN 1 AND 4),
p AS (SELECT left(word, n) AS prefix, word FROM (SELECT word, unnest(range(1, length(word) + 1)) AS n FROM dictionary))
SELECT s.word, count(p.word) AS n_prefixed, coalesce(bool_or(p.word = s.word), false) AS in_dictionary,
  coalesce(array_to_string(list_sort(list(p.word) FILTER (p.word IS NOT NULL)), ' '), '') AS superstrings
FROM s LEFT JOIN p ON s.word = p.prefix GROUP BY s.word
""")
def dict_prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    strings = _words(spark, d).where(F.length("word").between(1, 4)).select("word").distinct()
    out = dictionary.prefix_counts(strings, part_words(spark, d), matched=True)
    return out.withColumn("superstrings", F.array_join("superstrings", " "))


SQL_SURNAMES = f"surnames AS (SELECT DISTINCT unnest({sql_tokens('p_name')}) AS word FROM part)"


@query(f"""
WITH {TOKENS}, {SQL_DICTIONARY}, surnames AS (SELECT DISTINCT word FROM (SELECT unnest({sql_tokens('text')}) AS word FROM benchmark) WHERE word <> ''),
few AS (SELECT s.word FROM surnames s JOIN dictionary w ON starts_with(w.word, s.word) GROUP BY s.word HAVING count(*) < 5)
SELECT DISTINCT id FROM tokens WHERE word IN (SELECT word FROM few)
""")
def surname_prefix(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("word")).where("word <> ''")
    return dictionary.contains_member_prefix(_words(spark, d), names, part_words(spark, d))


@query(f"""
WITH {TOKENS}, {SQL_DICTIONARY}, p AS (SELECT DISTINCT left(word, n) AS prefix FROM (SELECT word, unnest(range(1, length(word) + 1)) AS n FROM dictionary))
SELECT DISTINCT id FROM tokens WHERE word <> '' AND word NOT IN (SELECT prefix FROM p)
""")
def nondict_prefix(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.contains_nonprefix(_words(spark, d), part_words(spark, d))


SQL_PHRASES = """phrases AS (SELECT DISTINCT w[1] || ' ' || w[2] AS phrase FROM (SELECT string_split(lower(text), ' ') AS w FROM benchmark)
  UNION SELECT 'thing' UNION SELECT 'es de')"""
SQL_SHORT = f"{SQL_DOCUMENT_LINES}, short AS (SELECT doc_id, line_no, lower(query) AS text FROM lines)"


def _phrases(spark: SparkSession, d: str) -> DataFrame:
    w = F.split(F.lower("text"), " ")
    rows = table(spark, d, "benchmark").select(F.concat(F.try_element_at(w, F.lit(1)), F.lit(" "), F.try_element_at(w, F.lit(2))).alias("phrase"))
    return rows.where("phrase IS NOT NULL").union(spark.createDataFrame([("thing",), ("es de",)], "phrase string")).distinct()


def _short(spark: SparkSession, d: str) -> DataFrame:
    return document_lines(spark, d).select("doc_id", "line_no", F.lower("query").alias("text"))


HOLDS = "EXISTS (SELECT 1 FROM phrases p WHERE contains(' ' || s.text || ' ', ' ' || p.phrase || ' '))"


@query(f"WITH {SQL_SHORT}, {SQL_PHRASES} SELECT count(*) AS n_texts FROM short s WHERE {HOLDS}")
def keyphrase_count(spark: SparkSession, d: str) -> DataFrame:
    return phrases.keyphrase_count(_short(spark, d), "text", _phrases(spark, d))


LOT = "('0x' || substr(md5('{seed}:' || {key}), 1, 4))::INTEGER"


def lot_sql(key: str, seed: int = 1) -> str:
    return LOT.format(seed=seed, key=key)


def fraction_sql(key: str, seed: int = 1) -> str:
    return f"((('0x' || substr(md5('{seed}:' || {key}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


@query(f"""WITH {SQL_SHORT}, {SQL_PHRASES} SELECT doc_id, line_no::INTEGER AS line_no, text FROM short s WHERE {HOLDS}
ORDER BY {lot_sql("(s.doc_id || '/' || s.line_no)")}, s.doc_id, s.line_no LIMIT 20""")
def phrase_samples(spark: SparkSession, d: str) -> DataFrame:
    found = phrases.matching(_short(spark, d), "text", _phrases(spark, d))
    lot = sampling.lot(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("line_no").cast("string")))
    return found.orderBy(lot, "doc_id", "line_no").limit(20)


@query(f"""WITH {SQL_DOCUMENT_LINES}, b AS (SELECT doc_id, query FROM lines) SELECT doc_id, count(*) AS n FROM b
WHERE contains(query, 'thing') OR ends_with(query, 'es.') OR contains(lower(query), 'license') GROUP BY doc_id""")
def phrase_containment(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("query")
    pattern = T.alternation(["license"], literal=True)
    return document_lines(spark, d).where(q.contains("thing") | q.endswith("es.") | q.rlike(pattern)).groupBy("doc_id").agg(F.count("*").alias("n"))


SQL_NGRAMS = f"""toks AS (SELECT {sql_tokens('text')} AS t FROM documents),
grams AS (SELECT unnest(list_concat(list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1])),
  list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) AS phrase FROM toks),
counts AS (SELECT phrase, count(*) AS n FROM grams GROUP BY phrase)"""


#: DuckDB's edit distance counts bytes: letters outside ASCII are put as single bytes that lower-case text lacks.
BYTES = "translate(phrase, 'àâäáãéèêëíìîïñóòôöúùûüçßœæ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return phrases.ngram_counts(table(spark, d, "documents"), "text", 3)


@query(f"WITH {SQL_NGRAMS} SELECT phrase, n FROM counts ORDER BY n DESC, phrase LIMIT 50")
def ngrams_top(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d).orderBy(F.desc("n"), "phrase").limit(50)


@query(f"""WITH {SQL_NGRAMS}, keys AS (SELECT unnest(['thing', 'license', 'licensed under', 'en']) AS keyphrase)
SELECT keyphrase, phrase, n, levenshtein({BYTES}, keyphrase)::BIGINT AS distance FROM counts, keys WHERE levenshtein({BYTES}, keyphrase) <= 2
ORDER BY n DESC, keyphrase, phrase LIMIT 40""")
def misspellings_top(spark: SparkSession, d: str) -> DataFrame:
    keys = spark.createDataFrame([("thing",), ("license",), ("licensed under",), ("en",)], "phrase string")
    return phrases.misspellings(_counts(spark, d), keys, 2).orderBy(F.desc("n"), "keyphrase", "phrase").limit(40)


@query("""
WITH k AS (SELECT vec_id AS key_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 100 = 0)
SELECT e.vec_id, round(max(list_cosine_similarity(e.embedding::DOUBLE[], k.v)), 6) AS similarity FROM embeddings e, k GROUP BY e.vec_id
""")
def similar_vectors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    keys = e.where("vec_id % 100 = 0").select(F.col("v").alias("k"))  # the stated query set, against all rows
    return e.crossJoin(keys).groupBy("vec_id").agg(F.round(F.max(phrases.cosine(F.col("v"), F.col("k"))), 6).alias("similarity"))


@query()
def similar_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Rows only: greedy choice of phrases that don't hold one another, in each label's group."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    own = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("k"))
    rows = e.join(own, "label").select("label", F.concat(F.lit("p"), F.col("vec_id") % 100).alias("phrase"), phrases.cosine(F.col("v"), F.col("k")).alias("score"))
    best = rows.groupBy("label", "phrase").agg(F.max("score").alias("score"))
    return phrases.disjoint(best, "label", "phrase", "score")


def _pattern_sql(kind: str, pattern: str, score: float) -> str:
    return f"list_transform(regexp_extract_all(text, '({pattern})', 1), lambda x: {{'type': '{kind}', 'text': x, 'score': {score}::DOUBLE}})"


LUHN_SQL = """(list_sum(list_transform(range(length(dg)), lambda i: CASE WHEN (length(dg) - i) % 2 = 0
  THEN dg[i + 1]::INTEGER * 2 - CASE WHEN dg[i + 1]::INTEGER > 4 THEN 9 ELSE 0 END ELSE dg[i + 1]::INTEGER END)) % 10 = 0)"""
SQL_ENTITIES = f"""raw AS ({' UNION ALL '.join(f"SELECT doc_id, '{k}' AS type, unnest(regexp_extract_all(text, '({p})', 1)) AS entity, {s}::DOUBLE AS base FROM documents" for k, (p, s) in scanners.PATTERNS.items())}),
entities AS (SELECT doc_id, type, entity, CASE WHEN type = 'CREDIT_CARD' AND {LUHN_SQL} THEN 1.0 ELSE base END AS score
  FROM (SELECT *, regexp_replace(entity, '[^0-9]', '', 'g') AS dg FROM raw))"""


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", scanners.scan(F.col("text")).alias("entities"))


@query(f"WITH {SQL_ENTITIES} SELECT doc_id, type, entity, score FROM entities")
def entity_scan(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.type", F.col("e.text").alias("entity"), "e.score")


@query(f"""WITH {SQL_ENTITIES}, c AS (SELECT type, score, count(*) AS n FROM entities GROUP BY type, score)
SELECT type, score, n, round(n / sum(n) OVER (PARTITION BY type), 6) AS share FROM c""")
def entity_score_distribution(spark: SparkSession, d: str) -> DataFrame:
    out = evaluate.group_share(evaluate.value_counts(entity_scan(spark, d), ["type", "score"]), ["type"])
    return out.withColumn("share", F.round("share", 6))


@query(f"""WITH {SQL_ENTITIES}, b AS (SELECT doc_id, max(score) AS s FROM entities WHERE type <> 'PHONE_NUMBER' GROUP BY doc_id)
SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN s >= 0.8 THEN 'high' WHEN s >= 0.4 THEN 'med' ELSE 'low' END AS bucket FROM b) GROUP BY bucket""")
def entity_bucket(spark: SparkSession, d: str) -> DataFrame:
    left = _entities(spark, d).select(scanners.without(F.col("entities"), ["PHONE_NUMBER"]).alias("e")).where("e IS NOT NULL")
    return evaluate.value_counts(left.select(scanners.score_bucket(F.col("e")).alias("bucket")), ["bucket"])


SQL_FLAGS = f"""{SQL_ENTITIES}, flags AS (SELECT d.doc_id, coalesce(bool_or(e.type <> 'SECRET_TOKEN'), false) AS a, regexp_matches(any_value(d.text), '[0-9]') AS b
  FROM documents d LEFT JOIN entities e USING (doc_id) GROUP BY d.doc_id)"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).select("doc_id", scanners.detected(F.col("entities"), ["SECRET_TOKEN"]).alias("a"), T.has_digit(F.col("text")).alias("b"))


@query(f"""WITH {SQL_FLAGS}, f AS (SELECT CASE WHEN a THEN 'yes' ELSE 'no' END AS first, b FROM flags UNION ALL SELECT 'total', b FROM flags)
SELECT first, count(*) FILTER (b) AS second_yes, count(*) FILTER (NOT b) AS second_no, count(*) AS second_total FROM f GROUP BY first""")
def scanner_confusion(spark: SparkSession, d: str) -> DataFrame:
    return scanners.confusion(_flags(spark, d), "a", "b")


@query(f"""WITH {SQL_FLAGS}, j AS (SELECT f.a, l.quality::VARCHAR AS g, l.toxic::VARCHAR AS t FROM flags f JOIN labels l USING (doc_id)),
e AS (SELECT g AS grouping, t AS label, a FROM j UNION ALL SELECT g, 'total', a FROM j UNION ALL SELECT 'total', 'total', a FROM j)
SELECT grouping, label, count(*) FILTER (a) AS n_flagged, count(*) FILTER (NOT a) AS n_unflagged FROM e GROUP BY grouping, label""")
def scanner_by_label(spark: SparkSession, d: str) -> DataFrame:
    rows = _flags(spark, d).join(table(spark, d, "labels"), "doc_id")
    return scanners.by_label(rows, "a", "quality", "toxic")


PII = "('EMAIL', 'IP_ADDRESS', 'PHONE_NUMBER', 'CREDIT_CARD', 'US_SSN', 'IBAN_CODE')"


@query(f"""WITH {SQL_ENTITIES} SELECT l.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN true END, bool_or(e.type IN ('EMAIL', 'IP_ADDRESS', 'PHONE_NUMBER', 'CREDIT_CARD')), false) AS is_pii
FROM labels l LEFT JOIN entities e USING (doc_id) GROUP BY l.doc_id, l.toxic""")
def annotation_defaults(spark: SparkSession, d: str) -> DataFrame:
    name = {"EMAIL": "email", "IP_ADDRESS": "IPaddress", "PHONE_NUMBER": "phonenumber", "CREDIT_CARD": "financial"}
    to = F.create_map(*[F.lit(x) for kv in name.items() for x in kv])
    types = F.transform(F.coalesce("entities", F.array().cast(scanners.ENTITY)), lambda e: F.coalesce(F.try_element_at(to, e["type"]), F.lit("other")))
    rows = table(spark, d, "labels").join(_entities(spark, d), "doc_id", "left").select("doc_id", types.alias("types"), F.when(F.col("toxic") == 1, True).alias("mark"))
    return evaluate.annotated_pii(rows, ["doc_id"], "types", "mark")


@query("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN l.toxic IS NULL THEN 'no' WHEN l.toxic = 1 THEN 'yes' ELSE 'maybe' END AS label
FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY label""")
def label_recode(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return evaluate.value_counts(rows.select(evaluate.recode(F.col("toxic").cast("string"), {"1": "yes", "0": "maybe"}).alias("label")), ["label"])


@query("""SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations WHERE conv_id IS NOT NULL) WHERE n = 1""")
def terminal_query_per_session(spark: SparkSession, d: str) -> DataFrame:
    return sessions.terminal_queries(table(spark, d, "conversations"), "conv_id", "turn")


#: A typed log out of the events: the j-th event of a user types the first characters of a word.
SQL_TYPED = """typed AS (SELECT event_id AS row, user_id, ts, substr('amazon prime video'::VARCHAR, 1, 1 + ((event_id * 7) % 11)::INTEGER) AS query FROM events),
links AS (SELECT a.row, min(b.row) AS prefix_of FROM typed a JOIN typed b ON b.user_id = a.user_id AND b.row > a.row AND b.ts >= a.ts AND b.ts - a.ts < INTERVAL 6 HOUR
  AND length(b.query) - length(a.query) BETWEEN 1 AND 3 AND starts_with(b.query, a.query) GROUP BY a.row)"""


def _typed(spark: SparkSession, d: str) -> DataFrame:
    n = (F.lit(1) + (F.col("event_id") * 7) % 11).cast("int")
    return table(spark, d, "events").select(F.col("event_id").alias("row"), "user_id", "ts", F.substring(F.lit("amazon prime video"), F.lit(1), n).alias("query"))


@query(f"WITH {SQL_TYPED} SELECT row, prefix_of FROM links")
def intermediate_queries(spark: SparkSession, d: str) -> DataFrame:
    return sessions.prefix_links(_typed(spark, d), "ts", "query", "row", 6 * 3600, 1, 3, ["user_id"])


@query(f"""WITH RECURSIVE {SQL_TYPED}, walk AS (SELECT row, prefix_of AS nxt FROM links UNION ALL SELECT w.row, l.prefix_of FROM walk w JOIN links l ON w.nxt = l.row),
roots AS (SELECT row, max(nxt) AS root FROM walk GROUP BY row)
SELECT t.row, t.user_id, t.ts, t.query, l.prefix_of IS NOT NULL AS is_prefix, coalesce(l.prefix_of, -1) AS prefix_of, coalesce(r.root, t.row) AS full_query_idx
FROM typed t LEFT JOIN links l USING (row) LEFT JOIN roots r USING (row)""")
def full_query_labels(spark: SparkSession, d: str) -> DataFrame:
    return sessions.label_intermediate(_typed(spark, d), "ts", "query", 6 * 3600, 1, 3, ["user_id"], "row")


@query(f"""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {lot_sql('doc_id')}, doc_id) AS n FROM documents) WHERE n <= 5""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 5)


STRATA = [sampling.Stratum("short", 0, 500, "closed"), sampling.Stratum("middle", 500, 3000, "closed"), sampling.Stratum("long", 3000, 1e9, "closed", "closed")]


@query(f"""WITH s AS (SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END AS stratum FROM documents)
SELECT doc_id, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {lot_sql('doc_id', 2)}, doc_id) AS n FROM s) WHERE n <= 7""")
def interval_strata_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", sampling.stratum(F.col("n_chars"), STRATA).alias("stratum"))
    return sampling.stratified(rows.where("stratum IS NOT NULL"), "stratum", "doc_id", 7, seed=2)


@query(f"SELECT event_id, user_id FROM events WHERE {lot_sql('event_id')} < {int(0.01 * 65536)}")
def one_percent_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.share(table(spark, d, "events").select("event_id", "user_id"), "event_id", 0.01)


@query(f"""SELECT conv_id, turn, text FROM conversations WHERE conv_id = (SELECT conv_id FROM conversations GROUP BY conv_id ORDER BY {lot_sql('conv_id')}, conv_id LIMIT 1)""")
def session_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.session(table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")


@query("""SELECT d.lang, l.quality, count(l.toxic) AS n, round(avg((l.toxic = 1)::INTEGER), 6) AS rate FROM labels l JOIN documents d USING (doc_id) GROUP BY d.lang, l.quality""")
def recall_by_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return evaluate.rates(rows, F.col("toxic") == 1, ["lang", "quality"]).withColumn("rate", F.round("rate", 6))


@query(f"""WITH r AS (SELECT avg((quality = 1)::INTEGER) AS rate FROM labels), p AS (SELECT k // 1000 AS draw, any_value(rate) AS rate, avg((u < rate)::INTEGER) AS recall
  FROM (SELECT range AS k, {fraction_sql('range')} AS u FROM range(1000000)), r GROUP BY draw)
SELECT round(any_value(rate), 6) AS recall, round(quantile_cont(recall, 0.025), 6) AS low, round(quantile_cont(recall, 0.975), 6) AS high FROM p""")
def recall_ci(spark: SparkSession, d: str) -> DataFrame:
    out = evaluate.recall_interval(table(spark, d, "labels"), F.col("quality") == 1, 1000, 1000)
    return out.select(*[F.round(c, 6).alias(c) for c in ("recall", "low", "high")])


#: Templates of this library's own; the second one comes twice.
CONTEXTS = ("where does [name] live", "[name] photos", "[name] photos")


@query("""SELECT n_name, replace(t, '[name]', n_name) AS query FROM nation, (SELECT unnest(['where does [name] live', '[name] photos', '[name] photos']) AS t)""")
def context_cross(spark: SparkSession, d: str) -> DataFrame:
    templates = spark.createDataFrame([(c,) for c in CONTEXTS], "template string")
    return evaluate.contexts(table(spark, d, "nation").select("n_name"), "n_name", templates, "template").select("n_name", "query")


@query(f"""WITH w AS (SELECT c_mktsegment, count(*) AS w FROM customer GROUP BY c_mktsegment),
b AS (SELECT c_mktsegment, (sum(w) OVER (ORDER BY c_mktsegment) - w) / sum(w) OVER () AS lo, sum(w) OVER (ORDER BY c_mktsegment) / sum(w) OVER () AS hi FROM w)
SELECT draw, c_mktsegment FROM (SELECT range AS draw, {fraction_sql('range')} AS u FROM range(1000)) JOIN b ON u >= lo AND u < hi""")
def weighted_names(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("w"))
    return sampling.weighted_draws(w, "c_mktsegment", "w", 1000)


@query(r"""WITH q AS (SELECT DISTINCT trim(unnest(string_split(text, chr(10))), ' ') AS query FROM documents)
SELECT query, regexp_matches(query, '\d') AS has_num FROM q WHERE query <> '' AND NOT regexp_full_match(query, '[^\p{L}\p{N}\p{M}_]+') AND NOT contains(query, ':/') AND NOT contains(query, '@') AND NOT contains(query, ',')""")
def corpus_clean(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("query")).select(F.trim("query").alias("query")).where("query <> ''").distinct()
    q = q.where(~T.no_word_characters(F.col("query")) & ~F.col("query").contains(":/") & ~F.col("query").contains("@") & ~F.col("query").contains(","))
    return q.select("query", F.col("query").rlike(r"(?U)\d").alias("has_num"))


@query("""SELECT count(*) AS n, round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS sd, min(c) AS least, quantile_cont(c, 0.5) AS median, max(c) AS most FROM (SELECT count(*) AS c FROM events GROUP BY user_id)""")
def group_size_summary(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("c"))
    return c.agg(F.count("*").alias("n"), F.round(F.avg("c"), 6).alias("mean"), F.round(F.stddev("c"), 6).alias("sd"), F.min("c").alias("least"), F.percentile("c", F.lit(0.5)).alias("median"), F.max("c").alias("most"))


@query(f"""WITH a AS (SELECT DISTINCT unnest({sql_words('text')}) AS word FROM benchmark), b AS (SELECT DISTINCT unnest({sql_words('text')}) AS word FROM documents)
SELECT (SELECT count(*) FROM (SELECT word FROM a INTERSECT SELECT word FROM b)) AS n_both, (SELECT count(*) FROM (SELECT word FROM a UNION SELECT word FROM b)) AS n_any,
  (SELECT count(*) FROM (SELECT word FROM a EXCEPT SELECT word FROM b)) AS n_first_only, (SELECT min(translate(word, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'nopqrstuvwxyzabcdefghijklmNOPQRSTUVWXYZABCDEFGHIJKLM')) FROM a) AS first_rotated""")
def wordlist_sets(spark: SparkSession, d: str) -> DataFrame:
    words = lambda df: df.select(F.explode(T.words(F.col("text"))).alias("word")).distinct()
    a, b = words(table(spark, d, "benchmark")), words(table(spark, d, "documents"))
    one = lambda df, name: df.agg(F.count("*").alias(name))
    out = one(a.intersect(b), "n_both").crossJoin(one(a.union(b).distinct(), "n_any")).crossJoin(one(a.subtract(b), "n_first_only"))
    return out.crossJoin(a.agg(F.min(T.rot13(F.col("word"))).alias("first_rotated")))
