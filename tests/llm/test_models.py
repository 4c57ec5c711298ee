"""Learned operators: held-out accuracy, exact search against brute force, and edge cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from termsieve.llm import langid, toxicity

KIND = "doc_id long, text string, lang string, score double"
VOWELS = {"xx": ("ka", "ti", "mo", "ne"), "yy": ("sch", "ung", "eit", "fel"), "zz": ("ño", "ái", "lle", "qua")}


def prose(lang: str, rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(VOWELS[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    langs = [rng.choice(list(VOWELS)) for _ in range(600)]
    return [(i, prose(lang, rng, rng.randrange(3, 60)), lang, 0.0) for i, lang in enumerate(langs)]


def test_languages_of_held_out_rows(rows, spoken):
    got = {r.doc_id: r for r in langid.identified(rows(spoken, KIND)).collect()}
    held = [i for i in got if got[i].held_out]
    assert set(held) == {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([got[i].lang_pred == spoken[i][2] for i in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values()) and 0.8 < np.mean([got[i].score for i in held]) < 1


def test_rare_languages_are_learnt(rows):
    rng = random.Random(8)
    data = [(i, prose("xx", rng, 12), "xx", 0.0) for i in range(1500)] + [(5000 + i, prose("yy", rng, 12), "yy", 0.0) for i in range(12)]
    got = langid.identified(rows(data, KIND), settings=langid.Settings(sample=100)).collect()
    assert all(r.lang_pred == ("yy" if r.doc_id >= 5000 else "xx") for r in got)
    assert langid.sample_rates([{"lang": "a", "count": 10}, {"lang": "b", "count": 1000}, {"lang": "c", "count": 500}], 100) == {"a": 1.0, "c": 0.09, "b": 0.045}


def test_ftrl_agrees_with_a_dense_fit():
    """FTRL against plain gradient descent on the same penalised loss, on held-out rows; its weights are sparse."""
    rng = np.random.default_rng(7)
    s = langid.Settings(bits=6, l1=0.05, l2=0.01, passes=8)
    truth = rng.standard_normal((64, 3)) * (rng.random((64, 1)) < 0.4)
    x = np.where(rng.random((1200, 64)) < 0.3, rng.random((1200, 64)), 0.0)
    y = (x @ truth).argmax(1)
    rows = [(np.append(np.flatnonzero(v), 64), np.append(v[v != 0], 1.0)) for v in x]
    w = langid.train(rows[:900], y[:900].tolist(), 3, s)
    dense, one = np.zeros((65, 3)), np.hstack((x, np.ones((1200, 1))))
    for _ in range(3000):
        p = langid.softmax(one[:900] @ dense)
        p[np.arange(900), y[:900]] -= 1
        dense -= 0.3 * (one[:900].T @ p / 900 + s.l2 / 900 * dense)
        dense = np.sign(dense) * np.maximum(0, np.abs(dense) - 0.3 * s.l1 / 900)
    ours, plain = (one[900:] @ w).argmax(1), (one[900:] @ dense).argmax(1)
    assert (ours == y[900:]).mean() >= (plain == y[900:]).mean() - 0.02 and (ours == plain).mean() > 0.93


def test_long_texts_are_summed_in_parts():
    rng = np.random.default_rng(2)
    table, f, start = rng.random((50, 3)).astype(np.float32), rng.integers(0, 50, 2_500_000), np.array([0, 10, 2_200_000])
    want = [table[f[a:z]].astype(float).sum(0) for a, z in ((0, 10), (10, 2_200_000), (2_200_000, len(f)))]
    assert np.allclose(langid._sums(table, f, start), want, rtol=1e-3)


def test_language_edge_cases(rows, spoken):
    odd = [(1001, None, "xx", 0.0), (1002, "", None, 0.0), (1003, "123 !?", "yy", 0.0), (None, spoken[0][1], None, 0.0), (1004, "ka " * 200_000, None, 0.0)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(rows(spoken + odd, KIND)).collect()}
    assert got[1001] == got[1002] == got[1003] == ("und", 0.0) and got[1004][0] == "xx" and got[None][0] == spoken[0][2]
    assert {r.lang_pred for r in langid.identified(rows([(1, "ka", None, 0.0)], KIND)).collect()} == {"und"}
    assert langid.identified(rows([], KIND)).collect() == []


def test_frequencies_cover_all_rows(rows, spoken):
    n, df = langid.document_frequencies(rows(spoken, KIND).select("text").repartition(7), s := langid.Settings(orders=(1,)))
    space = next(f for _, f in langid.grams(np.array([32], np.uint32), s))[0]
    assert n == 600 and df[space] == 600 and df.max() <= 600


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)

    def vector():
        t = np.unique(rng.integers(0, 60, rng.integers(1, 9)))
        w = rng.random(len(t)) + 0.1
        return t, w / np.sqrt(w @ w)

    examples = [vector() for _ in range(500)]
    dense = np.zeros((500, 60))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w
    sparse, index = toxicity.BlockMaxIndex(examples, 60, 16, dense=0), toxicity.BlockMaxIndex(examples, 60, 16, dense=7)
    queries = [vector() for _ in range(100)]
    for (t, w), near, again in zip(queries, index.nearest(queries, 10), sparse.nearest(queries, 10), strict=True):
        q = np.zeros(60)
        q[t] = w
        assert np.allclose([c for c, _ in near], [c for c, _ in again])
        best = np.sort((dense @ q)[dense @ q > 0])[::-1][:10]
        assert np.allclose([c for c, _ in near], best, atol=1e-6) and all(np.isclose(dense[i] @ q, c, atol=1e-6) for c, i in near)


@pytest.fixture(scope="module")
def rude():
    rng = random.Random(9)
    insults, stem = ("blarg", "fnord", "zork"), "vexu"
    docs, labels = [], []
    for i in range(900):
        words = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(rng.randrange(5, 120))]
        bad = rng.random() < 0.12
        if bad:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(insults) if i % 2 else stem + rng.choice("abcdefg") * 2)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_of_held_out_rows(rows, rude):
    docs, labels = rude
    truth = dict(labels)
    given = [x for x in labels if x[0] % 5]
    got = {r.doc_id: r for r in toxicity.scored(rows(docs, "doc_id long, text string"), rows(given, "doc_id long, toxic int")).collect()}
    held = [i for i in got if got[i].held_out]
    assert set(held) == {i for i in got if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(got[i].predicted == int(got[i].score >= 0.7) for i in got)
    hits = [got[i].predicted for i in held if truth[i]]
    clean = [got[i].predicted for i in held if not truth[i]]
    assert np.mean(hits) >= 0.9 and np.mean(clean) <= 0.02
    some = next(got[i] for i in held if truth[i] and got[i].predicted)
    assert some.evidence and all(e.toxic in (0, 1) and 0 < e.cosine <= 1 + 1e-9 and e.id not in held for e in some.evidence)


def dense_neighbours(docs, learnt, s):
    """id -> the cosines and labels of the nearest examples by dense vectors, ids being equal to places."""
    terms = []
    for _, text in docs:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())
        terms.append(Counter(t for w in words for t in [(0, w), *[(n, w[:n]) for n in (4, 6) if len(w) > n]]))
    df, held = Counter(t for c in terms for t in c), Counter(t for i in learnt for t in terms[i])
    vocabulary = sorted(t for t, n in held.items() if n >= 2 and df[t] <= max(s.stop * len(docs), 10))
    toxic = [i for i in learnt if learnt[i]]
    weight = []
    for t in vocabulary:
        pos, neg = sum(t in terms[i] for i in toxic), sum(t in terms[i] for i in learnt if not learnt[i])
        ratio = math.log(((pos + 0.5) / (len(toxic) + 1)) / ((neg + 0.5) / (len(learnt) - len(toxic) + 1)))
        weight.append(math.log((1 + len(docs)) / df[t]) * (s.floor + max(0, math.sqrt(2 * pos * max(0, ratio)) - s.doubt)))
    x = np.array([[(1 + math.log(c[t])) * w if c[t] else 0.0 for t, w in zip(vocabulary, weight, strict=True)] for c in terms])
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    order = sorted(learnt)
    near = x @ x[order].T
    return {i: [(near[i, k], learnt[order[k]]) for k in np.argsort(-near[i])[: s.k] if near[i, k] > 0] for i in range(len(docs))}


def test_toxicity_evidence_is_the_dense_neighbours(rows, rude):
    docs, labels = rude[0][:400], rude[1][:400]
    s = toxicity.Settings(block=16)
    learnt = {i: y for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1 and i % 7}
    want = dense_neighbours(docs, learnt, s)
    got = toxicity.scored(rows(docs, "doc_id long, text string"), rows([x for x in labels if x[0] % 7], "doc_id long, toxic int"), settings=s).collect()
    assert len(got) == 400
    for r in got:
        assert np.allclose([e.cosine for e in r.evidence], [c for c, _ in want[r.doc_id]], atol=1e-5)
        cut = [c for c, _ in want[r.doc_id]]
        apart = [k for k in range(len(cut)) if min([abs(cut[k] - c) for j, c in enumerate(cut) if j != k], default=1) > 1e-4 and k < s.k - 1]
        assert all(r.evidence[k].toxic == want[r.doc_id][k][1] for k in apart)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="the synthetic tables are not here")
def test_models_on_the_synthetic_tables(spark):
    """What the README states: 14 of 18 toxic documents held out without a false alarm, 0.99 of the languages."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    both = toxicity.scored(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert np.mean([r.predicted for r in both if r.toxic]) >= 0.75 and np.mean([r.predicted for r in both if not r.toxic]) <= 0.01
    both = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert np.mean([r.lang == r.lang_pred for r in both]) >= 0.99


def test_lookup_finds_all_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64) & ~np.uint64(0xFF00))
    table = toxicity.Lookup(keys)
    assert (table.find(keys[::-1]) == np.arange(len(keys))[::-1]).all() and (table.find(keys + np.uint64(256)) == -1).all()
    assert (toxicity.Lookup(keys[:0]).find(keys) == -1).all()


def test_toxicity_of_one_text_of_an_id(rows, rude):
    docs, labels = rude
    more = [(5000, "blarg fnord zork blarg"), (5000, "quiet words of no harm"), (None, "blarg fnord zork blarg"), (None, None)]
    left = toxicity.without_toxic(rows(docs + more, "doc_id long, text string"), rows(labels, "doc_id long, toxic int"))
    assert sorted(str(r.text) for r in left.where("doc_id is null or doc_id = 5000").collect()) == ["None", "quiet words of no harm"]


def test_toxicity_edge_cases(rows, rude):
    docs, labels = rude
    odd = [(2001, None), (2002, ""), (None, "fnord zork blarg"), (2003, "word " * 300_000 + "blarg fnord zork"), (2004, "!!!")]
    table = rows([(*d, 1) for d in docs + odd], "doc_id long, text string, toxic int")
    marks = rows([(*x, "n") for x in labels] + [(3, 1, "n"), (None, 1, "n"), (4, None, "n")], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.scored(table, marks).collect()}
    assert got[2001].predicted == got[2002].predicted == got[2004].predicted == 0 and got[2001].score == got[2004].score
    assert got[2003].predicted == 1 and got[None].predicted == 1 and got[None].held_out is False
    left = toxicity.without_toxic(table, marks)
    assert left.columns == table.columns and 2003 not in {r.doc_id for r in left.select("doc_id").collect()}
    none = toxicity.scored(table.limit(5), marks.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.scored(table.limit(0), marks).collect() == []
