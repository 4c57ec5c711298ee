"""Exact and near duplicates, against brute force."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termsieve.llm import exact_dedup, idfilter, minhash, rp_forest
from termsieve.llm import text as T
from termsieve.llm.components import connected_components

DOC = "doc_id long, text string"


class Sets:
    """Union-find with the smallest member as root."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def near(base: list[str], edits: int, rng: random.Random) -> str:
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """Copies, a broad group of near copies, texts that share a passage, short texts and blanks."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [word() for _ in range(150)]
    texts = [near(base, rng.choice((0, 1, 2, 3, 5, 8)), rng) for _ in range(160)]
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]) for _ in range(60)]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 80))) for _ in range(120)]
    texts += ["a b c", "A  B\nC", "a b", "", "  \n", None, None, "one two three four five", "one two three four FIVE"]
    texts += [" ".join(word() for _ in range(5000))] * 2 + ["hello world again and again"] * 30
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {b" ".join(w)} if w else set()


def test_minhash_agrees_with_all_pairs(rows, corpus):
    sets = {i: shingles(t) for i, t in corpus}
    groups = Sets(sets)
    for a, b in combinations([i for i in sets if sets[i]], 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            groups.join(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(rows(corpus, DOC).repartition(5)).collect()}
    assert got == {i: (len(s), groups.root(i), groups.root(i) == i) for i, s in sets.items()}


def test_large_groups_are_compared_in_blocks(rows, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 8)
    some = rows(corpus[:200], DOC)
    a = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(some).collect()}
    monkeypatch.undo()
    assert a == {(r.doc_id, r.component_id) for r in minhash.near_duplicates(some).collect()}


def test_minhash_keeps_one_and_all_columns(rows):
    long = " ".join(f"w{k}" for k in range(40))
    df = rows([(5, long, 1), (2, long + " x", 2), (None, long, 3), (9, None, 4), (9, None, 4)], "doc_id long, text string, _gone int")
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r._gone for r in kept.collect()) == [2, 3, 4, 4]


@pytest.mark.parametrize("call", [minhash.near_duplicates, exact_dedup.exact_duplicates, minhash.keep_one, exact_dedup.keep_one])
def test_empty_tables(rows, call):
    assert call(rows([], DOC)).collect() == []


def test_signature_collisions_estimate_jaccard():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 1000).astype(np.uint64)
    sig = minhash.signatures([x[:800], x[200:]], 512)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.08


def test_word_hashes_follow_words():
    texts = [b"A bc\td", b"", b"bc  a \x0b d\xc3\xa9"]
    h, first = T.word_hashes([t.lower() for t in texts])
    assert first.tolist() == [0, 3, 3, 6] and h[0] == h[4] and h[1] == h[3] and h[2] != h[5]


def test_cuckoo_index_follows_a_dict():
    rng = random.Random(1)
    index, live = exact_dedup.CuckooIndex(2, kicks=4), {}
    for k in range(20000):
        key = hashlib.sha256(str(rng.randrange(6000)).encode()).digest()
        if rng.random() < 0.6:
            if key not in live:
                live[key] = k
                index.insert([key, k])
        else:
            assert index.delete(key) == (live.pop(key, None) is not None)
    assert {e[0]: e[1] for e in index.values()} == live and index.live == len(live) and index.mask + 1 > 2
    assert all(index.may_contain(k) and index.get(k)[1] == v for k, v in live.items())
    assert index.get(b"\0" * 32) is None


def test_exact_duplicates(rows, corpus):
    groups = {}
    low = lambda t: (t or "").encode().lower()
    for i, t in corpus:
        groups.setdefault(low(t), []).append(i)
    want = {i: (max(groups[low(t)]), len(groups[low(t)]), max(groups[low(t)]) == i, hashlib.sha256(low(t)).hexdigest()) for i, t in corpus}
    got = exact_dedup.exact_duplicates(rows(corpus, DOC).repartition(6))
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()} == want
    assert {r.doc_id for r in exact_dedup.keep_one(rows(corpus + corpus[:3], DOC)).collect()} == {i for i, w in want.items() if w[2]}


def test_exact_nulls_ties_and_repeats(rows):
    df = rows([(1, "A"), (1, "a"), (None, "a"), (None, "é"), (None, "É"), (3, None), (4, "")], DOC)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True), (None, None, 1, True), (3, 4, 2, False), (4, 4, 2, True)], key=str)


def test_exact_rows_with_null_and_repeated_ids_stay(rows):
    kind = "doc_id long, text string, _mark string, _own map<string,int>"
    data = [(None, "x", "a"), (None, "y", "a"), (None, "z", "a"), (8, "twice", "b"), (8, "Twice", "a"), (5, "alone", "a"), (5, "both", "a"), (9, "BOTH", "a"), (None, "both", "a"), (None, "n", "c"), (None, "N", "b")]
    got = exact_dedup.keep_one(rows([(*r, {"k": 1}) for r in data], kind))
    want = [(None, "x", "a"), (None, "y", "a"), (None, "z", "a"), (8, "Twice", "a"), (5, "alone", "a"), (9, "BOTH", "a"), (None, "N", "b")]
    assert got.columns == ["doc_id", "text", "_mark", "_own"] and sorted(((r.doc_id, r.text, r._mark) for r in got.collect()), key=str) == sorted(want, key=str)


def test_near_rows_of_a_shared_id_are_one_document(rows):
    long = " ".join(f"w{k}" for k in range(40))
    got = minhash.keep_one(rows([(2, long), (5, long + " x"), (5, "another text of seven words in all"), (6, long + " y"), (7, "own text"), (7, "other")], DOC))
    assert sorted((r.doc_id, len(r.text)) for r in got.collect()) == [(2, len(long)), (7, 5), (7, 8)]


def test_long_texts_are_hashed_in_segments(monkeypatch):
    raw = b" ".join(b"w%d" % (k % 700) for k in range(9000)) + b" " + b"x" * 5000
    whole, first = T.word_hashes([raw])
    monkeypatch.setattr(T, "BLOCK", 1000)
    parts, again = T.word_hashes([raw])
    assert (whole == parts).all() and first.tolist() == again.tolist() == [0, 9001]


def test_index_updates(rows):
    digests = lambda data: exact_dedup.digests(rows(data, DOC), "doc_id", "text")
    index = exact_dedup.update_index(None, digests([(1, "a"), (2, "b"), (3, "A")]))
    index = exact_dedup.update_index(index, digests([(9, "b"), (4, "c")]), digests([(0, "a"), (0, "zz")]))
    assert {(r.keep_id, r.group_size) for r in index.collect()} == {(9, 2), (4, 1)}


def test_without_ids(rows, spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("_h"), F.array(F.lit(1)).alias("_gone")).union(rows([(None, "n", [2])], "doc_id long, _h string, _gone array<int>"))
    left = idfilter.without_ids(df, "doc_id", spark.range(0, 500, 7))
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {None, *(i for i in range(500) if i % 7)}


def test_components(rows):
    edges = [(5, 1), (1, 5), (5, 9), (9, 12), (20, 21), (7, 7), (None, 3)] + [(100 + k, 101 + k) for k in range(40)] + [(200, 201 + k) for k in range(300)]
    got = {r.id: r.component for r in connected_components(rows(edges, "a long, b long")).collect()}
    want = Sets({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None:
            want.join(a, b)
    assert got == {i: want.root(i) for i in want.up if i not in (3, 7)}
    assert connected_components(rows([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((40, 24))
    x = np.concatenate([centers[rng.integers(0, 40, 900)] + 0.2 * rng.standard_normal((900, 24)), rng.standard_normal((1100, 24)), np.tile(rng.standard_normal(24), (50, 1))])
    return x.astype(np.float32)


def test_forest_recall(rows, cloud):
    x = cloud.astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    df = rows([(i, v.tolist()) for i, v in enumerate(cloud)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in rp_forest.near_vectors(df, settings=rp_forest.Settings(leaf=64)).collect()}
    n = np.array([got[i].n_links for i in range(len(x))])
    assert (n <= link.sum(1)).all() and n.sum() >= 0.95 * link.sum() and (n[-50:] == link[-50:].sum(1)).all()
    groups = Sets(range(len(x)))
    for a, b in zip(*np.nonzero(link), strict=True):
        groups.join(int(a), int(b))
    same = np.mean([got[i].component_id == groups.root(i) for i in range(len(x))])
    assert same >= 0.97 and all(got[i].kept == (got[i].component_id == i) for i in got)


def brute(x):
    """Numbers of links and components by all pairs."""
    x = x / np.linalg.norm(x, axis=1)[:, None]
    n, groups = np.zeros(len(x), np.int64), Sets(range(len(x)))
    for a in range(0, len(x), 2048):
        link = x[a : a + 2048] @ x.T >= 0.9
        n[a : a + 2048] = link.sum(1) - 1
        for i in range(len(link)):
            for j in np.flatnonzero(link[i])[:1]:
                groups.join(a + i, int(j))
    return n, groups


def measured(spark, x, **settings):
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x.astype(np.float32))})).repartition(8)
    got = rp_forest.near_vectors(df, settings=rp_forest.Settings(**settings)).toPandas().sort_values("vec_id")
    return got.n_links.to_numpy(), got.component_id.to_numpy()


def crowd(n, dim, spread, hot, rng):
    """Vectors of which a share lies in one dense group of different ones, and some in small groups."""
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    k = int(n * hot)
    x[:k] = x[0] + spread * rng.standard_normal((k, dim)) / dim**0.5
    small = n - k // 4
    x[small:] = x[small + np.arange(k // 4) // 4 * 4] + 0.3 * rng.standard_normal((k // 4, dim)) / dim**0.5
    return x[rng.permutation(n)]


@pytest.mark.parametrize("spread", [0.27, 0.33, 0.4])
def test_dense_groups_keep_their_links(spark, spread):
    x = crowd(12000, 64, spread, 1 / 3, np.random.default_rng(5)).astype(np.float32)
    n, component = measured(spark, x, sample=(2048, 4096))
    want, _ = brute(x.astype(float))
    assert (n <= want).all() and n.sum() >= 0.99 * want.sum() and want.sum() > 1e6 * (spread < 0.35)


def test_recall_at_fifty_thousand(spark):
    x = crowd(50000, 64, 0.27, 0.4, np.random.default_rng(6)).astype(np.float32)
    n, component = measured(spark, x)
    want, _ = brute(x.astype(float))
    assert (n <= want).all() and n.sum() >= 0.99 * want.sum() and (n[want < 20].sum() >= 0.99 * want[want < 20].sum() > 5000)


def test_forest_edge_cases(rows):
    bad = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.01, 0.0]), (8, [float("inf"), 0.0]), (9, [0.0, 1.0]), (None, [1.0, 0.01]), (10, [1.0, 0.0]), (10, [1.0, 0.0])]
    df = rows([(*r, "x") for r in bad], "vec_id long, embedding array<double>, leaf string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in rp_forest.near_vectors(df).collect()), key=str)
    want = [(1, 4, 1, True), (2, 4, 1, False), *((k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)), (11, 1, 11, True), (12, 1, 11, False), (None, 4, None, True), (10, 4, 1, False), (10, 4, 1, False)]
    assert got == sorted(want, key=str)
    assert rp_forest.near_vectors(df.limit(0)).collect() == []
    assert [r.n_links for r in rp_forest.near_vectors(df.where("vec_id = 3")).collect()] == [0]
