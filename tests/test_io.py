"""Readers, sinks, the stream and the jobs, over files in a temporary folder."""

from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from termsieve.operators import validation
from termsieve.plans import jobs
from termsieve.sources import readers, sinks
from termsieve.streaming.sanitize import sanitize_stream

DAY = dt.date(2024, 3, 1)


def log(ts, query, kind=readers.SUGGEST, rid="r", country="none"):
    fields = (rid, "s", "1", query, country, None, "none", "desktop", "fx", "linux")
    return (ts, (kind, fields))


@pytest.fixture()
def logs(rows):
    at = dt.datetime.combine(DAY, dt.time(10))
    data = [
        log(at, "two cups"), log(at, "2 cups", rid="r2"), log(at, "7up", rid="r3", country="US"), log(at, " \t", rid="r4"), log(at, None, rid="r5"),
        log(at, "maria smith", rid="r6"), log(at + dt.timedelta(days=1), "next day"), log(at, "other", kind="web.other"), log(at, "me@x", rid="r7"),
    ]
    return rows(data, readers.LOG_SCHEMA)


def test_names_and_dates():
    assert readers.parse_run_date("latest", dt.date(2024, 3, 2)) == (DAY, dt.date(2024, 3, 2))
    assert readers.parse_run_date("2024-03-01") == (DAY, dt.date(2024, 3, 2))
    assert readers.checked_name("a.b-c_1") == "a.b-c_1"
    with pytest.raises(ValueError):
        readers.checked_name("a; drop table b")


def test_day_of_logs(logs):
    got = readers.day_of_logs(logs, DAY, DAY + dt.timedelta(days=1))
    assert {(r.request_id, r.country) for r in got.collect()} == {("r", None), ("r2", None), ("r3", "US"), ("r6", None), ("r7", None)}
    stats = readers.term_stats(logs, DAY, DAY + dt.timedelta(days=1)).first()
    assert (stats.total_search_terms, stats.contained_blank) == (7, 1)
    assert readers.research_queries(logs).where("minute(query_timestamp) = 0").count() == 8
    last = readers.research_queries(logs.withColumn("jsonPayload", F.col("jsonPayload").withField("fields.sequence_no", F.when(F.col("jsonPayload.fields.rid") == "r6", "12").otherwise("9"))), terminal_only=True)
    assert [r["query"] for r in last.collect()] == ["maria smith"]


def test_text_readers(spark, tmp_path):
    (tmp_path / "names.csv").write_text("name,count\nSMITH,3\nNULL,1\nALL OTHER NAMES,9\n")
    assert {r.surname for r in readers.surnames(spark, str(tmp_path / "names.csv")).collect()} == {"smith", "null"}
    (tmp_path / "f").write_text("MARY           2.629  2.629      1\nPATRICIA       1.073  3.702      2\n")
    assert readers.fixed_width_names(spark, str(tmp_path / "f")).where("forename = 'mary'").first().rank == 1
    (tmp_path / "w").write_text(" a \nb\n\na\n")
    assert readers.word_list(spark, str(tmp_path / "w")).count() == 2
    (tmp_path / "q.tsv").write_text("AnonID\tQuery\n1\tx y\n")
    assert readers.delimited(spark, str(tmp_path / "q.tsv"), "AnonID long, Query string", "\t").first().Query == "x y"
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        for k in range(3):
            f.write(json.dumps({"index": {"_id": k}}) + "\n" + json.dumps({"title": f"t{k}", "category": ["c"]}) + "\n")
    got = readers.bulk_json(spark, str(tmp_path / "d.json.gz"), "title string, category array<string>")
    assert {r.title for r in got.collect()} == {"t0", "t1", "t2"}
    assert readers.bulk_json(spark, str(tmp_path / "d.json.gz"), "title string", 2).count() == 2
    (tmp_path / "l").write_text('{"a": 1}\nbroken\n')
    (tmp_path / "p").write_text('{"index": {"_id": 1}}\n{"index": 7, "title": "payload"}\n{"title": "t"}\n')
    assert {r.title for r in readers.bulk_json(spark, str(tmp_path / "p"), "title string").collect()} == {"payload", "t"}
    (tmp_path / "n.csv").write_text('query,language,category,expected_ner_removal\n"anna\nlee",en,should_remove,True\n')
    assert [tuple(r) for r in readers.labelled_queries(spark, str(tmp_path / "n.csv")).collect()] == [("anna\nlee", "en", "should_remove", True)]
    good, bad = readers.json_lines(spark, str(tmp_path / "l"), "a int")
    assert [r.a for r in good.collect()] == [1] and [r.line for r in bad.collect()] == ["broken"]


def test_statements(spark, tmp_path):
    (tmp_path / "c.ttl").write_text(
        '<https://x.org/c/Category:A_b> a :Category ;\n rdfs:label "A \\"b\\"" ;\n :pages "3" ;\n :subcategories "1" .\n'
        "<https://x.org/c/Category:H> a :HiddenCategory ;\n rdfs:label \"H\" ;\n :pages \"0\" ;\n :subcategories \"0\" .\n"
        "<https://x.org/c/Category:A_b> :isInCategory\n <https://x.org/c/Category:P>, <https://x.org/c/Category:Q> .\n"
    )
    info, link = readers.parse_statements(readers.statements(spark, str(tmp_path / "c.ttl")))
    assert {(r.key, r.hidden, r.num_pages) for r in info.collect()} == {("A_b", False, 3), ("H", True, 0)}
    assert [(r.key, r.parents) for r in link.collect()] == [("A_b", ["P", "Q"])]


def test_sinks(spark, rows, tmp_path):
    path = str(tmp_path / "sink")
    sinks.overwrite_day(rows([("a",), ("b",)], "q string"), path, DAY)
    sinks.overwrite_day(rows([("c",)], "q string"), path, DAY + dt.timedelta(days=1))
    sinks.overwrite_day(rows([("d",)], "q string"), path, DAY)
    assert {(r.q, r.date) for r in spark.read.parquet(path).collect()} == {("d", DAY), ("c", DAY + dt.timedelta(days=1))}
    sinks.overwrite_day(rows([], "q string, date string"), path, DAY)
    assert {r.q for r in spark.read.parquet(path).collect()} == {"c"}
    sinks.overwrite_sample_day(rows([], "q string"), path, DAY + dt.timedelta(days=1))
    assert spark.read.parquet(path).count() == 0 and not list((tmp_path / "sink").glob("_new*"))
    sinks.write_csv(rows([("x", 1)], "n string, k int"), str(tmp_path / "csv"), ["k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["k"]
    sinks.write_json_lines(rows([("x", 1)], "n string, k int"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().n == "x"
    assert sinks.dated_table("t", rows([(dt.datetime(2024, 3, 1, 5),)], "query_timestamp timestamp")) == "t_20240301"
    chunks = rows([([[(0, None), (1, ["e1", "e2"])], [(0, ["e3"])]],)], "r array<array<struct<index:int,errors:array<string>>>>")
    assert chunks.select(sinks.first_errors(F.col("r"))).first()[0] == ["e1", "e3"]
    t = sinks.Table(spark, "termsieve_test")
    with pytest.raises(ValueError):
        t.insert(rows([("a",)], "q string"))
    try:
        t.create(rows([("a",)], "q string")).insert(rows([("b",)], "q string"))
        assert sinks.Table(spark, "termsieve_test").load().rows().count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS termsieve_test")


def test_job(spark, rows, logs, tmp_path):
    path = lambda n: str(tmp_path / n)
    suggestions, names = rows([(["7up", "7up"],), (["cola"],)], "keywords array<string>"), rows([("cups",)], "surname string")
    got = jobs.sanitize_day(spark, logs, suggestions, names, "2024-03-01", path("sink"), path("sample"), path("meta"))
    assert {r["query"] for r in spark.read.parquet(path("sink")).collect()} == {"two cups", "7up"}
    assert (got["total_search_terms_analyzed"], got["contained_numbers"], got["contained_at"], got["contained_name"]) == (5, 1, 1, 1)
    assert got["sum_terms_containing_us_census_surname"] == 1
    with pytest.raises(Exception):  # noqa: B017
        jobs.sanitize_day(spark, logs.drop("jsonPayload"), suggestions, names, "2024-03-01", path("sink"), path("sample"), path("meta"))
    assert {r.status for r in spark.read.parquet(path("meta")).collect()} == {"SUCCESS", "FAILURE"}
    names = [f"termsieve_{n}" for n in ("languages", "metrics")]
    try:
        sinks.append_metadata(spark, path("meta"), status="SUCCESS", started_at=dt.datetime(2024, 3, 2, 1), finished_at=dt.datetime(2024, 3, 2, 2), total_search_terms_analyzed=10,
                              total_search_terms_removed_by_sanitization_job=4, sum_words_all_search_terms=25, languages={"en": 6, "de": 2})
        assert jobs.record_metrics(spark, path("meta"), *names) >= 1 and jobs.record_metrics(spark, path("meta"), *names) == 0
        row = spark.table(names[1]).where("avg_words_all_search_terms = 2.5").first()
        assert (row.pct_sanitized_search_terms, row.pct_terms_non_english, row.pct_uppercase_chars_all_search_terms) == (0.4, 0.25, None)
        assert jobs.validate(spark, names[1], path("report"), dt.date(2024, 3, 3)) >= 0 and spark.read.parquet(path("report")).count() == 8
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_report(spark, rows, tmp_path):
    cols = [c.metric for c in validation.CHECKS]
    data = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=k), *[float(k % 5)] * len(cols)) for k in range(60)]
    metrics = rows(data, "finished_at timestamp, " + ", ".join(f"{c} double" for c in cols))
    report = validation.report(metrics, today=dt.date(2024, 2, 29))
    sinks.append_report(report, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert back.count() == 8 and json.loads(back.first().range_test_vals_json) == back.first().range_test_vals


def test_stream(spark, rows, tmp_path):
    rows([("a",), ("b 1",), ("c@",), ("d 2",)], "query string").write.parquet(str(tmp_path / "in"))
    allowed = rows([("d 2",)], "word string")
    args = (spark, str(tmp_path / "in"), "query string", allowed, "query", str(tmp_path / "out"), str(tmp_path / "state"))
    sanitize_stream(*args)
    sanitize_stream(*args)  # nothing new
    assert {r["query"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a", "d 2"}
