"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two fixed permutations of the 32-bit universe are drawn: sigma scatters the shingles, and pi, circularly shifted by
k, gives coordinate k of every signature: min over the set of pi(sigma(x) - k). Bands of the signature put
documents into buckets; documents that meet there link only when their full shingle sets reach the similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsieve.llm import text as T
from termsieve.llm.components import agg_by, connected_components
from termsieve.llm.idfilter import id_bits, may_hold, without_ids
from termsieve.llm.runtime import discard, ship, shuffle_partitions, stored, tidied

_SIGNED = "id long, n_shingles long, d0 long, d1 long, bands array<long>"


@dataclass(frozen=True)
class Settings:
    """shingle: words in a shingle. A pair links when `den` * intersection >= `num` * union. bands of rows coordinates.

    With 32 bands of 4, a pair at 0.75 misses all buckets with probability 5e-6, one at 0.85 with 6e-11.
    """

    shingle: int = 5
    num: int = 75
    den: int = 100
    bands: int = 32
    rows: int = 4


def _permute(x: np.ndarray, odd: tuple[int, int]) -> np.ndarray:
    """A permutation of the 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(odd[0])
    x ^= x >> np.uint32(13)
    x *= np.uint32(odd[1])
    x ^= x >> np.uint32(16)
    return x


SIGMA, PI = (0x9E3779B1, 0x5BD1E995), (0x85EBCA6B, 0xC2B2AE35)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of `size` coordinates for each non-empty set of 64-bit shingle hashes."""
    out = np.empty((len(sets), size), np.uint32)
    lens = [len(s) for s in sets]
    i = 0
    while i < len(sets):
        j, n = i, 0
        while j < len(sets) and (j == i or n + lens[j] <= 16384):
            n += lens[j]
            j += 1
        scattered = _permute((np.concatenate(sets[i:j]) >> T.U64(32)).astype(np.uint32), SIGMA)
        starts = np.concatenate(([0], np.cumsum(lens[i : j - 1]))).astype(np.intp)
        for k in range(size):
            out[i:j, k] = np.minimum.reduceat(_permute(scattered - np.uint32(k), PI), starts)
        i = j
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature; the band's number is part of it."""
    keys = np.zeros((len(sig), bands), T.U64)
    for r in range(rows):
        keys = T.mix(keys * T.BASE + sig[:, r : bands * rows : rows].astype(T.U64) + T.STEP[r])
    return T.mix(keys + np.arange(bands, dtype=T.U64) * T.STEP[15]).view(np.int64)


def _sign(s: Settings):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), T.utf8(batch.column(1))
            for first, raw in T.blocks(texts):
                sets = T.shingles(*T.word_hashes(raw), s.shingle)
                full = [i for i, x in enumerate(sets) if len(x)]
                keys = band_keys(signatures([sets[i] for i in full], s.bands * s.rows), s.bands, s.rows) if full else np.empty((0, s.bands), np.int64)
                digests = np.zeros((len(sets), 2), np.int64)
                offsets = np.zeros(len(sets) + 1, np.int32)
                for i in full:
                    digests[i] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
                    offsets[i + 1] = s.bands
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(raw)),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(digests[:, 0].copy()),
                        pa.array(digests[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), pa.array(keys.ravel())),
                    ],
                    ["id", "n_shingles", "d0", "d1", "bands"],
                )

    return run


def signed(docs: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, n_shingles, d0, d1, bands) per row: set size, 128-bit digest of the set, and its band keys."""
    ship(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_sign(s), _SIGNED)


def _sets_of(s: Settings, shared):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = np.flatnonzero(may_hold(shared.value, batch.column(2).to_numpy()))
            if not len(inside):
                continue
            few = batch.take(pa.array(inside))
            texts = T.utf8(few.column(1))
            for first, raw in T.blocks(texts):
                sets = T.shingles(*T.word_hashes(raw), s.shingle)
                yield pa.RecordBatch.from_arrays([few.column(0).slice(first, len(raw)), pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "set"])

    return run


def candidate_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, set): the full shingle set of every document in ids, one row per id, as sorted 64-bit hashes."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(id_bits(ids))
    three = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    three = three.withColumn("h", F.xxhash64("id"))
    few = three.mapInArrow(_sets_of(s, shared), "id long, set binary")
    return few.join(ids, "id", "left_semi").groupBy("id").agg(F.max("set").alias("set"))


def linked(left: list[np.ndarray], right: list[np.ndarray], s: Settings) -> np.ndarray:
    """Which sets of the left block reach the similarity with which of the right one, on their full contents."""
    sizes = [len(x) for x in (*left, *right)]
    tokens, column, df = np.unique(np.concatenate((*left, *right)), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    common = df[column] > 1  # other shingles are in no intersection
    row, column = row[common], (np.cumsum(df > 1) - 1)[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)))
    width = 2048
    for first in range(0, int((df > 1).sum()), width):
        a, z = np.searchsorted(column, (first, first + width))
        dense = np.zeros((len(sizes), width), np.float32)
        dense[row[a:z], column[a:z] - first] = 1
        both += dense[: len(left)] @ dense[len(left) :].T
    n, m = np.array(sizes[: len(left)], float), np.array(sizes[len(left) :], float)
    return s.den * both >= s.num * (n[:, None] + m[None, :] - both)


def _block_links(s: Settings):
    """Edges that connect what the links inside a block, or between two blocks, connect: one a document at most."""

    def edges(rows: list[tuple[int, int, int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        i, j = rows[0][0], rows[0][1]
        left = [r for r in rows if r[2] == i]
        right = [r for r in rows if r[2] == j]
        ids = np.array([r[3] for r in left] + ([] if i == j else [r[3] for r in right]), np.int64)
        link = linked([r[4] for r in left], [r[4] for r in right], s) if left and right else np.zeros((0, 0), bool)
        n = len(ids)
        full = np.zeros((n, n), bool)
        if link.size:
            full[: len(left), n - len(right) :] = link
            full |= full.T
        np.fill_diagonal(full, True)
        low = ids.copy()
        while True:
            after = np.where(full, low[None, :], np.iinfo(np.int64).max).min(1) if n else low
            if (after == low).all():
                break
            low = after
        apart = low != ids
        return low[apart], ids[apart]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done() -> pa.RecordBatch:
            low, high = edges(rows)
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True))
            sets = batch.column(5)
            for k, (center, i, j, part, doc) in enumerate(keys):
                if (center, i, j) != key:
                    if len(rows) > 1:
                        yield done()
                    key, rows = (center, i, j), []
                rows.append((i, j, part, doc, np.frombuffer(sets[k].as_buffer(), T.U64)))
        if len(rows) > 1:
            yield done()

    return run


#: Documents and bytes of sets in a block of a group.
BLOCK_DOCS, BLOCK_BYTES = 128, 1 << 20


def similar_components(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, component) of every class that links with another one.

    Each bucket is put under the member with the most company in all its buckets, its center; a group is all that
    share a bucket of one center, so members of a bucket meet in a group. Copies of one text have few centers
    between them, and a document is in few groups. A group is compared in blocks, all pairs of blocks in tasks of
    their own, and gives edges that connect what its links connect: no pair of documents becomes a row.
    """
    spark = docs.sparkSession
    member = classes.select("id", "n_shingles", F.explode("bands").alias("key"))
    crowd = agg_by(member, "key", F.count("*").alias("crowd")).where("crowd > 1")
    member = stored(member.join(crowd, "key"), "buckets")
    fame = stored(agg_by(member, "id", F.sum("crowd").alias("fame"), F.max("n_shingles").alias("n_shingles")), "candidates")
    sets = stored(candidate_sets(docs, fame.select("id"), id_col, text_col, s), "sets")
    known = stored(member.select("key", "id").join(fame, "id"), "buckets")
    top = agg_by(known, "key", F.max(F.struct("fame", -F.col("id"))).alias("top")).select("key", (-F.col("top.col2")).alias("center"))
    group = known.join(top, "key").groupBy("center", "id").agg(F.max("n_shingles").alias("n_shingles"))
    group = stored(group, "groups")
    size = agg_by(group, "center", F.count("*").alias("n"), F.sum("n_shingles").alias("m"))
    by_docs = F.ceil(F.col("n") / F.greatest(F.lit(BLOCK_DOCS), F.least(F.lit(8 * BLOCK_DOCS), F.col("n") / 32)))
    size = size.select("center", F.greatest(by_docs, F.ceil(8 * F.col("m") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    dealt = group.join(size, "center").withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.select("center", "id", "part", other.alias("other"))
    pairs = pairs.select("center", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id")
    full = stored(pairs, "block-pairs").join(sets, "id").select("center", "i", "j", "part", "id", "set")
    parts = max(shuffle_partitions(spark), -(-8 * (group.agg(F.sum("n_shingles")).first()[0] or 0) // (32 << 20)))
    tasks = full.repartition(parts, "center", "i", "j").sortWithinPartitions("center", "i", "j")
    edges = stored(tasks.mapInArrow(_block_links(s), "a long, b long"), "edges")
    discard(spark, [member, known])
    return stored(connected_components(edges), "labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links, kept marks the row with that id. Null or wordless texts
    have no shingles and link with nothing; texts below five words are one shingle. Equal sets are one class, found
    by a 128-bit digest before any pair is made. Repeated rows share their result; rows with a null id are compared
    with nothing and kept, with a null component_id. Other columns are not read. Empty tables give empty tables.
    """
    s = settings or Settings()
    sign = stored(signed(docs, id_col, text_col, s), "signatures")
    known = sign.where("n_shingles > 0 and id is not null")
    classes = known.groupBy("d0", "d1").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    label = similar_components(docs, classes.select("id", "n_shingles", "bands"), id_col, text_col, s)
    named = classes.select("d0", "d1", "id").join(label, "id", "left")
    named = stored(named.select("d0", "d1", F.coalesce("component", "id").alias("component")), "components")
    out = sign.drop("bands").join(named, ["d0", "d1"], "left")
    lone = F.col("id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(lone, F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """The documents without those that a similar one with a smaller id replaces; all columns stay.

    Rows with a null id stay. Rows that share an id are one document, linked through any of its texts: it stays or
    goes as a whole.
    """
    gone = near_duplicates(docs, id_col, text_col, settings).where("not kept").select(F.col(id_col).alias("id"))
    return without_ids(docs, id_col, gone)
