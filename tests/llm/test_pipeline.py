"""The pipeline against plain Python, and the guard that lets the rest live without this subpackage."""

from __future__ import annotations

import random
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from termsieve.llm import registry
from tests.llm.test_dedup import Sets, near, shingles

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = [" ".join(word() for _ in range(rng.randrange(20, 200))) for _ in range(400)]
    for k in range(40):
        texts.append(texts[k].upper() if k % 2 else texts[k])
    for k in range(60, 90):
        texts.append(near(texts[k].split(), 1, rng))
    labels = []
    for i in range(len(texts)):
        bad = i % 9 == 5 and i < 400
        if bad:
            w = texts[i].split()
            for x in ("grubbel", "snarfot", "grubbel"):
                w.insert(rng.randrange(len(w)), x)
            texts[i] = " ".join(w)
        labels.append((i, 1, int(bad)))
    path = tmp_path_factory.mktemp("sf")
    docs = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), docs


def test_stages(spark, folder):
    path, docs = folder
    now, text = spark.read.parquet(f"{path}/documents.parquet"), {d[0]: d[1] for d in docs}
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    now = stages["toxicity"](spark, now, path)
    assert ids(now) == [i for i in text if "grubbel" not in text[i].lower()]
    last = {}
    for i in ids(now):
        last[text[i].lower()] = i
    now = stages["exact dedup"](spark, now, path)
    assert ids(now) == sorted(last.values())
    sets = {i: shingles(text[i]) for i in last.values()}
    groups = Sets(sets)
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                groups.join(a, b)
    now = stages["near dedup"](spark, now, path)
    assert ids(now) == sorted({groups.root(i) for i in sets}) and len(ids(now)) < len(sets)
    before, now = now, stages["mixing"](spark, now, path)
    assert now.columns == before.columns and set(ids(now)) <= set(ids(before))
    mixed = {}
    for r in now.collect():
        mixed.setdefault(r.doc_id, []).append(r.text)
    assert all(text[i].lower().split()[: len(t.split())] == t.lower().split() for i, ts in mixed.items() for t in ts)
    share = {s: sum(len(t.split()) for i, ts in mixed.items() for t in ts if i % 4 == s) for s in range(4)}
    total = sum(len(r.text.split()) for r in before.collect())
    assert all(abs(share[s] / total - w / 7) < 0.02 for s, w in enumerate((1, 2, 3, 1)))
    out = stages["packing"](spark, now, path)
    assert out.where("start = 0").count() == sum(map(len, mixed.values()))


KIND = "doc_id long, text string, lang string, source string, n_chars long, _own int, _mark string"


def test_stages_stand_odd_rows(spark, folder, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing columns and empty tables."""
    path, docs = folder
    odd = [(9001, None, None, None, None), (9002, "", "en", "s1", 0), (9003, "", "en", None, 0), (None, "a text of no id at all", None, "s1", 1), (None, None, None, None, None),
           (9004, "long " * 120_000, "en", "s2", 600_000), (9005, "one row twice here", "en", "s3", 18), (9005, "one row twice here", "en", "s3", 18)]
    table = spark.createDataFrame([(*r, 1, "m") for r in docs[:150] + odd], KIND)
    now = table
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, path)
        if name != "packing":
            assert now.columns == table.columns and all(r._own == 1 and r._mark == "m" for r in now.collect())
        if name == "exact dedup":
            kept = [(r.doc_id, r.text) for r in now.where("doc_id is null or doc_id > 9000").collect()]
            assert sorted(i for i, _ in kept if i) == [9003, 9004, 9005] and [t for i, t in kept if i is None] == ["a text of no id at all"]
        if name == "near dedup":
            assert now.count() >= before.count() - 5 and now.where("doc_id is null").count() == 1
    rows = now.collect()
    assert sum(r.length for r in rows) > 100_000 and {r.doc_id for r in rows} >= {None, 9004}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), path).collect() == []


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_and_queries(spark, folder, tables):
    assert corpus_pipeline.run(spark, folder[0]).count() > 0
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in registry.queries()] == list(range(1, 11))
    assert registry.queries()["op5_license_scan"](spark, tables).count() > 0


def test_entry_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "termsieve", "corpus_pipeline.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "termsieve/llm")
    (tmp_path / "corpus_pipeline.py").unlink()
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
