"""Lines, licences, shards, mixes and packs."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from termsieve.llm import licenses, line_dedup, mixing, packing, sharding
from tests.compare import rows_of

PAGE = "page_id long, url string, html string"


def page(k, lines, host="a.org", tag="p"):
    return (k, f"http://{host}/x?{k}", "<html><head><title>t</title><script>var x='<p>no</p>';</script></head><body>" + "".join(f"<{tag}>{x}</{tag}>" for x in lines) + "<!-- c --></body></html>")


PAGES = [page(k, ["menu", f"own {k}", "menu", "rare" if k < 2 else f"x{k} &amp; <b>y</b>"]) for k in range(10)] + [page(20 + k, ["menu"], "B.org", "div") for k in range(2)] + [
    (30, None, "<p>alone</p>"), (31, "", None), (32, "http://c.org", ""), (None, "http://a.org/z", "<br>menu<br>\tq  r\n s")]


def test_lines(rows):
    got = {r.page_id: r for r in line_dedup.without_boilerplate(rows([(*p, "h") for p in PAGES], PAGE + ", site string")).collect()}
    assert got[3].text == "own 3\nx3 & y" and (got[3].n_lines, got[3].n_dropped) == (5, 3)
    assert got[1].text == "own 1\nrare" and got[20].text == "t\nmenu" and got[20].host == "b.org"
    assert (got[30].host, got[30].text) == (None, "alone") and got[31].host == "" and got[31].n_lines == 0 and got[None].text == "q r\ns"
    assert line_dedup.without_boilerplate(rows([], PAGE)).collect() == []


def test_lines_agree_with_sql(rows, tables):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    cur = con.execute(line_dedup.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    df = line_dedup.without_boilerplate(rows(PAGES, PAGE))
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_line_plan_has_no_python(rows):
    plan = line_dedup.without_boilerplate(rows(PAGES, PAGE))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_licences_are_found(rows):
    rng = random.Random(2)
    prose = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n)) + ". "
    docs, want = [], {}
    for i, (name, text) in enumerate(licenses.TEMPLATES * 3):
        docs.append((i, prose(30) + "\n" + prose(20) + text + "\n" + prose(40) * 3))
        want[i] = name
    docs += [(1000, prose(50)), (1001, None), (1002, ""), (1003, "His licence was a copyright on nothing."), (None, "x\nReleased under the MIT License.\ny")]
    docs.append((1004, prose(200_000 // 40) * 10 + "\nLicensed under the Apache License, Version 2.0.\n" + prose(100)))
    got = {}
    for r in licenses.scanned(rows(docs, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {i: [r.license for r in got.get(i, [])] for i in want} == {i: [n] for i, n in want.items()}
    assert not {1000, 1001, 1002, 1003} & set(got) and got[None][0].license == "MIT" and got[1004][0].license == "Apache-2.0"
    texts = dict(docs)
    assert all(texts[i][r.start : r.end] == r.notice and 0 < r.saved < 1 for i, rs in got.items() for r in rs)
    assert all(r.exact and not r.differences for i in want for r in got[i])


def test_licence_names():
    names = {"Apache-2.0", "MIT", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC0-1.0", "Unlicense"}
    assert {name for name, _ in licenses.TEMPLATES} == names
    mozilla = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    scan = licenses.Scanner(licenses.Settings())
    for notice in (mozilla, mozilla + " If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."):
        name, _, share, rest = scan.best(notice)
        assert name == "MPL-2.0" and share == 1 and rest == []


def test_licence_wording_differences():
    scan = licenses.Scanner(licenses.Settings())
    name, _, share, rest = scan.best("Licensed under the Apache License, Version 1.1.")
    assert name == "Apache-2.0" and share == 6 / 7 and rest == ["-2.0 +"]
    assert scan.best("We granted permission to nobody.") is None
    name, _, share, rest = scan.best("Released under the very old MIT License.")
    assert name == "MIT" and rest == ["- +very old"]


@pytest.mark.parametrize("sign", ["", "# ", " * "])
def test_wrapped_licences_are_found(sign):
    s = licenses.Settings()
    scan = licenses.Scanner(s)
    for width in range(60, 81, 4):
        for name, notice in licenses.TEMPLATES:
            lines = textwrap.wrap(notice, width - len(sign), break_on_hyphens=False, break_long_words=False)
            text = f"{sign}Some file\n{sign}\n" + "\n".join(sign + x for x in lines) + f"\n{sign}\n\nimport this\n"
            got = [row for a, b in licenses.blocks(text, s) for row in scan.notices(text[a:b])]
            assert [(r[2], r[4], r[5]) for r in got] == [(name, 1, [])], (width, notice, got)


def test_neighbouring_licences_are_all_found(rows):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    gpl = [t for name, t in licenses.TEMPLATES if name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0")]
    docs = [mit + " " + apache, mit + "\n" + apache, apache + "\n" + mit, "Licensed under the MIT License or the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 or the MIT License.",
            " ".join(gpl), "\n".join(t for _, t in licenses.TEMPLATES), mit + "\n" + mit, "His licence. " * 200 + "Licensed under CC BY 4.0. " + "Their licence. " * 200]
    texts = dict(enumerate(docs))
    got = {}
    for r in licenses.scanned(rows(list(texts.items()), "doc_id long, text string")).collect():
        assert texts[r.doc_id][r.start : r.end] == r.notice
        got.setdefault(r.doc_id, []).append(r.license)
    both = ["Apache-2.0", "MIT"]
    assert [sorted(got[i]) for i in range(5)] == [both] * 5
    assert sorted(got[5]) == sorted(name for name, _ in licenses.TEMPLATES if name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0"))
    assert sorted(got[6]) == sorted(name for name, _ in licenses.TEMPLATES)
    assert got[7] == ["MIT", "MIT"] and got[8] == ["CC-BY-4.0"]


def test_cue_on_two_lines(rows):
    text = "This is free and unencumbered software released into the public\n# domain."
    assert [r.license for r in licenses.scanned(rows([(1, text)], "doc_id long, text string")).collect()] == ["Unlicense"]


def test_shards_round_trip(spark, rows, tmp_path):
    data = [(i % 97 if i % 11 else None, f"text {i} " * (i % 50), i) for i in range(3000)]
    docs = rows(data, "doc_id long, text string, shard int")
    out = sharding.sharded(docs, f"file://{tmp_path}/s", settings=sharding.Settings(target=40_000, fan=3))
    assert out.columns == [*docs.columns, "_shard", "shard_rows", "shard_bytes"]
    got = sorted(((r.doc_id, r.text, r.shard) for r in out.collect()), key=str)
    assert got == sorted(data, key=str)
    assert all(r["count"] == r.shard_rows for r in out.groupBy("_shard", "shard_rows").count().collect())
    assert sharding.sharded(docs.limit(0), f"file://{tmp_path}/e").collect() == []


def test_manifests(spark, rows, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/m", sharding.Settings(target=1 << 20, fan=2))
    one, two = rows([(1, "a")], "k int, t string"), rows([(2, "b")], "k int, t string")
    first = store.append(one.coalesce(1))
    assert first.version == 1 and store.manifest().version == 1
    assert not store.commit(sharding.Manifest(1, [], 0))  # another writer's version stands
    store.append(two.coalesce(1))
    assert [len(g) for g in store.due(store.manifest())] == [2]
    last = store.compact(one.schema)
    assert last.version == 3 and len(last.shards) == 1 and last.shards[0]["rows"] == 2 and last.shards[0]["arrival"] == 0
    assert {r.k for r in store.read(one.schema, 1).collect()} == {1} and {r.k for r in store.read(one.schema).collect()} == {1, 2}
    assert store.vacuum() == 0  # young files may be another writer's
    assert store.vacuum(0) == 2 and {r.k for r in store.read(one.schema).collect()} == {1, 2}
    assert store.tier(1 << 20) == 0 and store.tier(1 << 19) == 0 and store.tier(1 << 18) == 1 and store.tier(1 << 25) == 0


def test_two_writers_at_once(spark, rows, tmp_path):
    stores = [sharding.ShardStore(spark, f"file://{tmp_path}/w") for _ in range(2)]
    base = [s.manifest() for s in stores]
    assert [s.commit(sharding.Manifest(b.version + 1, [], k)) for k, (s, b) in enumerate(zip(stores, base, strict=True))] == [True, False]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda k: stores[k % 2].append(rows([(k,)], "k int").coalesce(1)).version, range(16)))
    assert sorted(versions) == list(range(2, 18)) and {r.k for r in stores[0].read("k int").collect()} == set(range(16))
    assert not [p for p in (tmp_path / "w/manifests").iterdir() if not p.name.lstrip(".").startswith("v")]


@pytest.mark.parametrize("sizes", [[100] * 5, [120] * 4, [125] * 4, [90] * 5, [63] * 9, [1] * 500, [40, 50, 60, 3, 3, 3, 3, 30, 31, 32], list(range(1, 130))])
def test_compaction_ends(spark, tmp_path, sizes):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/e", sharding.Settings(target=128))
    shards = [{"name": str(k), "bytes": n, "rows": 1, "arrival": k} for k, n in enumerate(sizes)]
    turns = 0
    while groups := store.due(sharding.Manifest(1, shards)):
        assert all(len(g) > 1 for g in groups)
        for g in groups:
            total = sum(x["bytes"] for x in g)
            assert total <= 1.5 * 128 and (total >= 128 or len(g) >= 4)
            gone = {x["name"] for x in g}
            turns += 1
            shards = [x for x in shards if x["name"] not in gone] + [{"name": f"m{turns}", "bytes": int(0.8 * total), "rows": 1, "arrival": g[0]["arrival"]}]
    assert turns < len(sizes) and max(Counter(store.tier(x["bytes"]) for x in shards if x["bytes"] < 64).values(), default=0) < 4


def test_merged_files_come_near_the_target(spark, rows, tmp_path):
    docs = rows([(i, hashlib.sha256(str(i).encode()).hexdigest() * 8) for i in range(6000)], "doc_id long, text string").repartition(20)
    out = sharding.sharded(docs, f"file://{tmp_path}/n", settings=sharding.Settings(target=100_000))
    sizes = [r.shard_bytes for r in out.select("shard", "shard_bytes").distinct().collect()]
    assert len(sizes) > 4 and sum(50_000 <= n <= 150_000 for n in sizes) >= len(sizes) - 3 and max(sizes) <= 150_000
    assert out.count() == out.distinct().count() == 6000
    held = [p for p in (tmp_path / "n/data").rglob("part-*.parquet")]
    assert len(held) == len(sizes)  # what merged files replaced is gone


def test_shards_keep_clashing_columns(rows, tmp_path):
    names = ("_from", "_file", "_k", "_r", "_b", "lot", "shard_name", "Shard_Rows")
    docs = rows([(i, None if i % 3 else "x" * i, *[f"{n}{i}" for n in names]) for i in range(30)], ", ".join(["doc_id long", "text string", *[f"{n} string" for n in names]]))
    out = sharding.sharded(docs, f"file://{tmp_path}/c")
    assert out.columns == [*docs.columns, "shard", "_shard_rows", "shard_bytes"]
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def water(sizes: dict, weights: dict) -> dict:
    """Targets by bisection of the level, for a check of the closed form."""
    total, lo, hi = sum(sizes.values()), 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(3 * sizes[k], mid * weights[k]) for k in sizes) < total:
            lo = mid
        else:
            hi = mid
    return {k: min(3 * sizes[k], lo * weights[k]) for k in sizes}


def test_mixing(rows):
    rng = random.Random(8)
    docs = []
    for i in range(2500):
        source = rng.choice(["b", "b", "b", "b", "b", "B", "é", None, "tiny"] if i > 5 else ["tiny"])
        if source == "tiny" and i > 5:
            source = "b"
        docs.append((i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.choice((0, 3, 40, 400)))), source))
    docs.append((9000, None, "empty"))
    df = rows(docs, "doc_id long, text string, source string")
    got = mixing.mixed(df.repartition(5)).collect()
    size = {i: len((t or "").split()) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in {*source.values()}}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)})
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]] and r.taken <= 3 * r.size
        assert r.target == pytest.approx(want[source[r.doc_id]], rel=1e-6, abs=1e-6)
    for s in sizes:
        taken = sum(r.taken for r in got if source[r.doc_id] == s)
        assert abs(taken - want[s]) <= max(60, 0.01 * want[s])
    again = {(r.doc_id, r.taken) for r in mixing.mixed(df.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    words = {}
    for r in mixing.mix(df).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r.taken for r in got if r.taken}


def test_mixing_edge_cases(rows):
    kind = "doc_id long, text string, source string, part int, block int"
    df = rows([(1, "a b c", "x", 1, 1), (1, "a b c", "x", 1, 1), (None, "d e", None, 1, 1), (2, "", "x", 1, 1)], kind)
    got = mixing.mixed(df).collect()
    assert len(got) == 4 and sum(r.taken for r in got) <= 3 * 8 and {r.size for r in got} == {3, 2, 0}
    assert mixing.mix(df).columns == df.columns
    assert mixing.mixed(df.limit(0)).collect() == [] and mixing.mix(df.limit(0)).collect() == []
    assert [r.taken for r in mixing.mixed(df.where("doc_id = 2")).collect()] == [0]


def test_mix_keeps_clashing_columns(rows):
    names = ("_bucket", "_n", "_pass", "_short", "_part", "_name", "_passes", "_cut", "_at", "_taken", "_size", "_id", "id", "size", "part", "column0")
    data = [(i, None if i % 13 == 0 else "w " * (i % 40), None if i % 5 == 0 else f"s{i % 3}", *[7] * len(names)) for i in range(200)] + [(None, "a b c", "s1", *[7] * len(names)), (3, "w w w", "s0", *[7] * len(names))]
    docs = rows(data, ", ".join(["doc_id long", "Text string", "source string", *[f"{n} int" for n in names]]))
    out = mixing.mix(docs, text_col="text")
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(set(r[3:]) == {7} and r.Text for r in got)
    taken = {r.doc_id: r.taken for r in mixing.mixed(docs, text_col="Text").where("doc_id > 3").collect()}
    words = Counter()
    for r in got:
        words[r.doc_id] += len(r.Text.split())
    assert all(words[i] == n for i, n in taken.items())
    assert mixing.mix(docs.limit(0), text_col="Text").collect() == []


def test_tiny_sources_beside_a_large_one(rows):
    s = mixing.Settings(slots=64)  # blocks of some 3000 words
    sizes = {"a": 200_000, "b": 3, "c": 200, "d": 400, "e": 800, "f": 1600, "g": 9000}
    docs = [(k, i) for k, n in sizes.items() for i in range(0, n, 97)]
    docs = [(j, " ".join(f"{k}{i}" for i in range(i, min(i + 97, sizes[k]))), k) for j, (k, i) in enumerate(docs)]
    df = rows(docs, "doc_id long, text string, source string")
    source, taken = {i: k for i, _, k in docs}, dict.fromkeys(sizes, 0)
    target = {}
    for r in mixing.mixed(df, settings=s).collect():
        assert r.size and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for k in sizes:
        assert abs(taken[k] - target[k]) <= 1 + 0.02 * target[k], (k, taken, target)
    words = dict.fromkeys(sizes, 0)
    for r in mixing.mix(df, settings=s).collect():
        words[r.source] += len(r.text.split())
    assert words == taken


def test_golden_slots_are_spread(spark):
    plan = [("a", 1000, 600.0), ("b", 1000, 300.0), ("c", 1000, 100.0)]
    got = sorted(tuple(r) for r in mixing.schedule(spark, plan, 1, 3).collect())
    parts = [r[1] for r in got]
    for cut in (50, 333, 1000):
        assert all(abs(parts[:cut].count(k) - cut * share) <= 4 for k, share in enumerate((0.6, 0.3, 0.1)))
    assert all([r[2] for r in got if r[1] == k] == list(range(parts.count(k))) for k in range(3))


def best(ends, costs, length):
    """Least cost by trying every cut: padding of all windows but the last, plus penalties."""
    at, cost = [0, *ends], [0.0] + [float("inf")] * len(ends)
    for j in range(1, len(at) - 1):
        cost[j] = min((cost[i] + length - (at[j] - at[i]) + costs[j - 1] for i in range(j) if at[j] - at[i] <= length), default=float("inf"))
    return min(cost[i] for i in range(len(at) - 1) if at[-1] - at[i] <= length)


def test_cuts_are_optimal():
    rng = random.Random(6)
    for _ in range(200):
        ends = np.cumsum([rng.randrange(1, 20) for _ in range(rng.randrange(1, 40))]).tolist()
        costs = [rng.choice((0.0, 3.0, 8.0)) for _ in ends]
        marks = packing.cuts(ends, costs, 20)
        at = [0, *(ends[j] for j in marks)]
        assert at[-1] == ends[-1] and all(b - a <= 20 for a, b in zip(at, at[1:], strict=False))
        got = sum(20 - (b - a) + costs[j] for a, b, j in zip(at[:-2], at[1:-1], marks, strict=False))
        assert got == pytest.approx(best(ends, costs, 20))


ODD = ["Don't stop, it's 12.5% — ÇA VA? été ΣΑΣ İstanbul <|endoftext|> x''s I'LL we'RE ǅ ﬁ ½ ²³ _a_b_ 中文 😀😀 \x1c\x1d z", "", None, " \n\t", "'s 's't o'd", "ab " * 30_000, "x" * 30_000]


def test_packs_round_trip(rows):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    texts = ODD + [" ".join(rng.choice(("The", "cat.", "sat", "down!", "Été", f"n{rng.randrange(99)}")) for _ in range(rng.randrange(0, 900))) for _ in range(200)]
    df = rows([(i if i != 50 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(2)
    file = packing.tokenizer_file()
    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True
    want = {i if i != 50 else None: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in enumerate(texts)}
    got = packing.digest(packing.packed(df)).collect()
    docs, sequences = {}, {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(want[r.doc_id])
        docs.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(docs) == set(want)
    for spans, total in [(v, len(want[k])) for k, v in docs.items()] + [(v, None) for v in sequences.values()]:
        place = 0
        for start, n in sorted(spans):
            assert start == place and n > 0
            place += n
        assert place == total if total else place <= 4096
    lengths = [sum(n for _, n in v) for v in sequences.values()]
    padding = sum(4096 - n for n in lengths if n & (n - 1))
    assert padding <= 0.02 * sum(lengths)
    assert packing.packed(df.limit(0)).collect() == []


def test_packing_remembers_pieces_not_words():
    from tokenizers import Tokenizer

    encoder = packing.Encoder(packing.tokenizer_file())
    texts = [" ".join(f"Word{n}{mark}" for n in range(k, k + 500)) for k in range(0, 20_000, 500) for mark in (".", "***", "-a")]
    got = [ids.tolist() for ids in encoder.texts(pa.array(texts))]
    assert len(encoder.memory.pool) < 1000  # letters, ten digits and marks, each learnt once
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_encodes_as_the_tokenizer_does_however_little_it_remembers(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(10)
    some = [*"abzAZ09 '.,!-_\t\n\x00\x1c\x7f\xa0", *"éÉßÞ×÷ÿªº²ŒœΣσǅİſ中😀٣\u0301\u0338\u200b", "'s", "'LL", "l'été", " ", " ", "abcdefghijklmno", "éééééééé"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [*ODD, "a", "a\x00", "a\x00\x00", *("a" * n for n in range(7, 18)), "é.1" * 9000]
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    tokenizer.encode_special_tokens = True
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for remembered in (packing.REMEMBERED, 1000, 1):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        encoder = packing.Encoder(packing.tokenizer_file())
        parts = [pa.array(texts[i : i + 200], pa.string()) for i in range(0, len(texts), 200)]
        assert [ids.tolist() for part in parts for ids in encoder.texts(part)] == want
