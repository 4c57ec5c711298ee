"""Near-duplicate vectors by a forest of random-projection trees with spill.

A node splits along a random direction near the median of a bounded sample's projections; vectors between two bounds
around the cut go down both sides. Trees are added until pairs made at the very threshold, and linked pairs of the
sample, meet in some leaf. Where links are dense, the cut and its spill are chosen so that next to no linked pair of the
sample comes apart; a node that has no such cut becomes a dense leaf, since its pairs are links for the most part.

Inside a leaf every pair is compared exactly, in double precision. Large leaves are compared in blocks, all pairs of
blocks in tasks of their own, and links are counted and joined without making rows of pairs. A pair may meet in many
leaves; it is counted in the first one only (dense leaves come first), which both vectors' leaf lists tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsieve.llm import text as T
from termsieve.llm.components import connected_components
from termsieve.llm.runtime import ship, shuffle_partitions, stored, tidied


@dataclass(frozen=True)
class Settings:
    """Leaves of about `leaf` vectors; the share 2 * spill goes down both sides of a split, more where links are dense.

    Trees are fitted on a sixteenth of the vectors, `sample[0]` at least and `sample[1]` at most, and end where a node
    has fewer than 2 * least of them: beyond leaf * sample[1] / (2 * least) vectors, leaves grow with the table and are
    compared in more blocks. missed: share of threshold pairs that may meet in no tree; most: trees in any case.
    dense: share of links among a node's pairs from which cuts are chosen with care. block: vectors of a block.
    lengths: vector lengths that have a forest, commonest first; vectors of another length are one leaf.
    """

    cosine: float = 0.9
    leaf: int = 256
    spill: float = 0.05
    sample: tuple[int, int] = (16384, 131072)
    least: int = 8
    missed: float = 0.001
    most: int = 64
    dense: float = 0.002
    block: int = 1024
    lengths: int = 16
    seed: int = 11


SPLIT, CLOSED, DENSE = 0, 1, 2
#: Codes of leaves that aren't dense start here.
SPARSE = 1 << 30
#: Vectors of the sample whose pairs are all compared, linked pairs of them that are kept, and threshold pairs.
PAIRED, LINKED, PROBES = 8192, 100_000, 2000


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have one: finite throughout and not zero."""
    x = vectors.astype(np.float64)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(1, initial=0)
        good = np.isfinite(top) & np.isfinite(x).all(1) & (top > 0)
        x = x / np.where(good, top, 1)[:, None]
        x = x / np.sqrt((x * x).sum(1))[:, None]
    return np.where(good[:, None], x, 0.0), good


class Pairs:
    """Linked pairs of the sample's first vectors, thinned to a bounded number."""

    def __init__(self, sample: np.ndarray, s: Settings, rng: np.random.Generator) -> None:
        own = sample[:PAIRED]
        self.members = len(own)
        count = sum(int((own[a : a + 1024] @ own.T >= s.cosine).sum()) for a in range(0, len(own), 1024)) - len(own)
        self.share = min(1.0, LINKED / max(1, count // 2))
        found = [(np.empty(0, np.int64),) * 2]
        for a in range(0, len(own), 1024):
            i, j = np.nonzero(np.triu(own[a : a + 1024] @ own.T >= s.cosine, a + 1))
            kept = rng.random(len(i)) < self.share
            found.append((i[kept] + a, j[kept]))
        self.i, self.j = (np.concatenate(x) for x in zip(*found, strict=True))


class Tree:
    """Bounds and states of a tree's nodes, level by level; every node of a level has the same direction."""

    def __init__(self, number: int, sample: np.ndarray, rows: int, pairs: Pairs, s: Settings) -> None:
        self.number, self.s = number, s
        depth = 0
        while rows / 2**depth > s.leaf and len(sample) / 2 ** (depth + 1) >= s.least:
            depth += 1
        d = np.random.default_rng([s.seed, sample.shape[1], number]).standard_normal((sample.shape[1], depth))
        self.directions = d / np.linalg.norm(d, axis=0)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        weight, projected = rows / max(1, len(sample)), sample @ self.directions
        at, node = np.arange(len(sample)), np.zeros(len(sample), np.int64)
        pair, home = np.arange(len(pairs.i)), np.zeros(len(pairs.i), np.int64)
        for level in range(depth + 1):
            p = projected[at, level] if level < depth else np.zeros(len(at))
            order = np.lexsort((p, node))
            at, node, p = at[order], node[order], p[order]
            edges = np.searchsorted(node, np.arange((1 << level) + 1))
            size = np.diff(edges)
            state = np.where((size * weight > s.leaf) & (size >= 2 * s.least) & (level < depth), SPLIT, CLOSED).astype(np.int8)
            spot = lambda share, size=size, edges=edges: edges[:-1] + (share * np.maximum(size - 1, 0)).astype(np.int64)
            full = np.append(p, 0.0)
            lo, hi = full[np.minimum(spot(0.5 - s.spill), len(p))], full[np.minimum(spot(0.5 + s.spill), len(p))]
            if level < depth and len(pair):
                inside = np.bincount(node[at < pairs.members], minlength=1 << level)
                linked = np.bincount(home, minlength=1 << level)
                few = (linked < 8) | (linked / pairs.share < s.dense * inside * (inside - 1) / 2) | (state != SPLIT)
                by = np.argsort(home, kind="stable")
                place = np.searchsorted(home[by], np.arange((1 << level) + 1))
                for k in np.flatnonzero(~few).tolist():
                    own = pair[by[place[k] : place[k + 1]]]
                    a, b = projected[pairs.i[own], level], projected[pairs.j[own], level]
                    cut = self._careful(p[edges[k] : edges[k + 1]], np.minimum(a, b), np.maximum(a, b))
                    if cut is None:
                        state[k] = DENSE
                    else:
                        lo[k], hi[k] = cut
            self.levels.append((lo, hi, state))
            at, node = self._down(at, node, p, level)
            if len(pair) and level < depth:
                a, b = projected[pairs.i[pair], level], projected[pairs.j[pair], level]
                go = state[home] == SPLIT
                left, right = go & (np.maximum(a, b) <= hi[home]), go & (np.minimum(a, b) >= lo[home])
                pair, home = np.concatenate((pair[left], pair[right])), np.concatenate((2 * home[left], 2 * home[right] + 1))
            if not len(at):
                break

    def _careful(self, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[float, float] | None:
        """Bounds of the evenest cut that leaves all but a fiftieth of the linked pairs together; none if it is too uneven."""
        low, high = low[:2000], high[:2000]
        share = np.linspace(0.25, 0.75, 11)
        spot = lambda x: own[np.clip(x * (len(own) - 1), 0, len(own) - 1).astype(int)]
        cut = spot(share)
        wide = np.maximum(np.quantile(np.minimum(cut[:, None] - low, high - cut[:, None]), 0.98, axis=1), 0)
        lo, hi = np.minimum(cut - wide, spot(share - self.s.spill)), np.maximum(cut + wide, spot(share + self.s.spill))
        larger = np.maximum(np.searchsorted(own, hi, "right"), len(own) - np.searchsorted(own, lo, "left")) / len(own)
        k = int(larger.argmin())
        return (lo[k], hi[k]) if larger[k] <= 0.8 else None

    def _down(self, at: np.ndarray, node: np.ndarray, p: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi, state = self.levels[level]
        go = state[node] == SPLIT
        left, right = go & (p <= hi[node]), go & (p >= lo[node])
        return np.concatenate((at[left], at[right])), np.concatenate((2 * node[left], 2 * node[right] + 1))

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, code of the leaf) for every leaf that a row of x falls into."""
        projected = x @ self.directions
        at, node, rows, codes = np.arange(len(x)), np.zeros(len(x), np.int64), [], []
        for level, (_, _, state) in enumerate(self.levels):
            own = state[node]
            here = own != SPLIT
            rows.append(at[here])
            codes.append((self.number << 18) + (1 << level) + node[here] + np.where(own[here] == DENSE, 0, SPARSE))
            if here.all():
                break
            at, node = self._down(at, node, projected[at, level], level)
        return np.concatenate(rows), np.concatenate(codes)


class Forest:
    """Trees fitted on a sample of the vectors: as many as it takes for pairs at the threshold to meet."""

    def __init__(self, sample: np.ndarray, rows: int, s: Settings) -> None:
        rng = np.random.default_rng(s.seed)
        pairs, self.trees = Pairs(sample, s, rng), []
        a = sample[:PROBES]
        b = rng.standard_normal(a.shape)
        b -= (a * b).sum(1)[:, None] * a
        b = s.cosine * a + np.sqrt(1 - s.cosine**2) * b / np.maximum(np.linalg.norm(b, axis=1), 1e-300)[:, None]
        some = rng.permutation(len(pairs.i))[:PROBES]
        probes = [(a, b), (sample[pairs.i[some]], sample[pairs.j[some]])]
        apart = [np.ones(len(x), bool) for x, _ in probes]
        while len(self.trees) < s.most:
            tree = Tree(len(self.trees), sample, rows, pairs, s)
            self.trees.append(tree)
            for (x, y), left in zip(probes, apart, strict=True):
                one, two = (r << 32 | c for r, c in (tree.leaves(x), tree.leaves(y)))
                left[np.intersect1d(one, two) >> 32] = False
            if all(left.mean() <= s.missed for left in apart if len(left)) and (len(self.trees) > 3 or tree.levels[0][2][0] != SPLIT):
                break

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) over all trees, sorted."""
        found = [t.leaves(x) for t in self.trees]
        at, code = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((code, at))
        return at[order], code[order]


def _first_dense(at: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each (row, dense leaf) the row's first dense leaf if that is another one, else -1; -1 for other leaves."""
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    first = np.repeat(code[start], np.diff(np.append(start, len(at))))
    return np.where((code < SPARSE) & (first < code), first, -1)


def _matrix(column: pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    """Rows of an array column as a matrix; null rows, nulls inside and other lengths become nan."""
    out = np.full((len(column), dim), np.nan, kind)
    lengths = pa.compute.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == dim)
    if len(fits):
        flat = column.take(pa.array(fits)).flatten()
        out[fits] = flat.to_numpy(zero_copy_only=False).reshape(len(fits), dim)
    return out


def _parts(batches: Iterator[pa.RecordBatch], dim: int, place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            part = batch.slice(i, 2048)
            yield part, unit(_matrix(part.column(place), dim))[0]


def _count(shared, dim: int):
    """(leaf, first dense leaf, vectors) of each stretch of rows."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _parts(batches, dim, 0):
            at, code = shared.value.leaves(x)
            key, n = np.unique(code << 32 | (_first_dense(at, code) + 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key >> 32), pa.array((key & 0xFFFFFFFF) - 1), pa.array(n)], ["leaf", "first", "n"])

    return run


class Deal:
    """How the leaves' vectors are dealt out over blocks, and which blocks are compared.

    Vectors of a dense leaf that share an earlier dense leaf were compared there: blocks of them aren't paired again.
    """

    def __init__(self, counts: list[tuple[int, int, int]], block: int) -> None:
        counts = sorted(counts)
        self.keys = np.array([leaf << 32 | (first + 1) for leaf, first, _ in counts], np.int64)
        self.blocks = np.array([-(-n // block) for _, _, n in counts], np.int64)
        self.starts = np.zeros(len(counts), np.int64)
        self.totals = np.zeros(len(counts), np.int64)
        self.rows = 0
        k = 0
        while k < len(counts):
            z = k
            while z < len(counts) and counts[z][0] == counts[k][0]:
                z += 1
            own = self.blocks[k:z]
            self.starts[k:z] = np.cumsum(own) - own
            self.totals[k:z] = own.sum()
            self.rows += sum(counts[m][2] * self.partners(m) for m in range(k, z))
            k = z

    def partners(self, k: int) -> int:
        """Blocks that a block of the group is paired with."""
        return int(self.totals[k] if self.keys[k] & 0xFFFFFFFF == 0 else self.totals[k] - self.blocks[k])

    def dealt(self, ids: np.ndarray, code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(entry, own block, other block) for every pair of blocks that an entry (row in a leaf) belongs to."""
        group = np.searchsorted(self.keys, code << 32 | (first + 1))
        own = self.starts[group] + (T.mix(ids.view(T.U64)) % self.blocks[group].astype(T.U64)).astype(np.int64)
        plain = np.flatnonzero((self.totals[group] == 1) & (first < 0))
        entries, owns, others = [plain], [own[plain]], [np.zeros(len(plain), np.int64)]
        rest = np.flatnonzero((self.totals[group] > 1))
        order = rest[np.argsort(group[rest], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(part):
                k = int(group[part[0]])
                other = np.arange(self.totals[k])
                if first[part[0]] >= 0:
                    other = other[(other < self.starts[k]) | (other >= self.starts[k] + self.blocks[k])]
                entries.append(np.repeat(part, len(other)))
                owns.append(np.repeat(own[part], len(other)))
                others.append(np.tile(other, len(part)))
        return np.concatenate(entries), np.concatenate(owns), np.concatenate(others)


_DEALT = "leaf int, i int, j int, own int, id long, copies long, vector binary, leaves array<int>"


def _deal(forest, deal, dim: int, kind: type):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _parts(batches, dim, 2):
            at, code = forest.value.leaves(x)
            ids = part.column(0).to_numpy()
            entry, own, other = deal.value.dealt(ids[at], code, _first_dense(at, code))
            if not len(entry):
                continue
            start = np.searchsorted(at, np.arange(len(x) + 1))
            raw = _matrix(part.column(2), dim, kind)
            vector = pa.array([v.tobytes() for v in raw], pa.binary())
            for a in range(0, len(entry), 1 << 15):
                e, own_, other_ = entry[a : a + (1 << 15)], own[a : a + (1 << 15)], other[a : a + (1 << 15)]
                row = at[e]
                before = e - start[row]  # the row's leaves that come first
                flat = np.repeat(start[row] - (np.cumsum(before) - before), before) + np.arange(before.sum())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(before))).astype(np.int32)), pa.array(code[flat].astype(np.int32)))
                place = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[e].astype(np.int32)), *(pa.array(c.astype(np.int32)) for c in (np.minimum(own_, other_), np.maximum(own_, other_), own_)),
                     part.column(0).take(place), part.column(1).take(place), vector.take(place), lists],
                    ["leaf", "i", "j", "own", "id", "copies", "vector", "leaves"],
                )

    return run


def _met_before(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which rows of the left share an earlier leaf with which of the right."""
    sides = [(np.repeat(np.arange(len(x)), [len(v) for v in x]), np.concatenate(x)) for x in (left, right)]
    out = np.zeros((len(left), len(right)), bool)
    both = np.intersect1d(sides[0][1], sides[1][1])
    for a in range(0, len(both), 2048):
        some = both[a : a + 2048]
        have = []
        for n, (row, code) in zip((len(left), len(right)), sides, strict=True):
            at = np.minimum(np.searchsorted(some, code), len(some) - 1)
            hit = some[at] == code
            m = np.zeros((n, len(some)), np.float32)
            m[row[hit], at[hit]] = 1
            have.append(m)
        out |= have[0] @ have[1].T > 0
    return out


def _lowest(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that the links (left x right) connect each row of either side to."""
    low, low2, high = left.copy(), right.copy(), np.iinfo(np.int64).max
    while True:
        a = np.minimum(low, np.where(link, low2[None, :], high).min(1, initial=high))
        b = np.minimum(low2, np.where(link, a[:, None], high).min(0, initial=high))
        if (a == low).all() and (b == low2).all():
            return low, low2
        low, low2 = a, b


def _meet(cosine: float, dim: int, kind: type):
    """(id, links, low): links first met in this leaf, and the smallest id that a pair of blocks connects id to."""

    def compare(ids: np.ndarray, copies: np.ndarray, x: np.ndarray, earlier: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool):
        link = x[left] @ x[right].T >= cosine
        if same:
            np.fill_diagonal(link, False)
        rows, cols = np.flatnonzero(link.any(1)), np.flatnonzero(link.any(0))
        if not len(rows):
            return None
        link, left, right = link[np.ix_(rows, cols)], left[rows], right[cols]
        low, low2 = _lowest(link, ids[left], ids[right])
        new = (link & ~_met_before([earlier[k] for k in left], [earlier[k] for k in right])).astype(np.float64)
        one = ids[left], new @ copies[right].astype(np.float64), low
        if same:
            return tuple(c.astype(np.int64) for c in (one[0], one[1], np.minimum(one[2], low2)))
        two = ids[right], copies[left].astype(np.float64) @ new, low2
        return tuple(np.concatenate(c).astype(np.int64) for c in zip(one, two, strict=True))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done() -> pa.RecordBatch | None:
            own, ids, copies = (np.array([r[k] for r in rows], np.int64) for k in range(3))
            x = unit(np.frombuffer(b"".join([r[3] for r in rows]), kind).reshape(len(rows), dim))[0]
            same = key[1] == key[2]
            left = np.arange(len(rows)) if same else np.flatnonzero(own == key[1])
            right = left if same else np.flatnonzero(own == key[2])
            found = compare(ids, copies, x, [r[4] for r in rows], left, right, same) if len(left) and len(right) else None
            return found and pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["id", "links", "low"])

        for batch in batches:
            heads = list(zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True))
            vectors, lists = batch.column(6).to_pylist(), batch.column(7)
            start, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, (leaf, i, j, own, doc, copies) in enumerate(heads):
                if (leaf, i, j) != key:
                    if len(rows) > 1 and (out := done()):
                        yield out
                    key, rows = (leaf, i, j), []
                rows.append((own, doc, copies, vectors[k], flat[start[k] : start[k + 1]]))
        if len(rows) > 1 and (out := done()):
            yield out

    return run


def _links(classes: DataFrame, dim: int, total: int, split: bool, s: Settings) -> DataFrame:
    """(id, links, low) of the classes (node, copies, vector, h1) of one length."""
    spark = classes.sparkSession
    few = max(s.sample[0], min(s.sample[1], total // 16))
    kind = np.float32 if dict(classes.dtypes)["vector"] == "array<float>" else np.float64
    lot = F.pmod(F.xxhash64(F.lit(s.seed), "h1"), F.lit(1 << 30))
    share = min(1.0, 1.02 * few / total)
    own = classes.where(lot < F.lit(int(share * (1 << 30)) + 1)).limit(few).select("vector").toArrow().column(0) if split else None  # `few` rows
    sample = unit(_matrix(own.combine_chunks(), dim))[0] if split else np.zeros((1, dim))
    forest = spark.sparkContext.broadcast(Forest(sample, total if split else 1, s))
    counts = classes.select("vector").mapInArrow(_count(forest, dim), "leaf long, first long, n long").groupBy("leaf", "first").agg(F.sum("n").alias("n"))
    deal = Deal([tuple(r) for r in counts.collect()], s.block)  # a row for each leaf, of bounded number, and dense leaf before it
    shared = spark.sparkContext.broadcast(deal)
    routed = classes.select("node", "copies", "vector").mapInArrow(_deal(forest, shared, dim, kind), _DEALT)
    parts = max(shuffle_partitions(spark), -(-deal.rows * (dim * np.dtype(kind).itemsize + 64) // (32 << 20)))
    tasks = routed.repartition(int(parts), "leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
    return stored(tasks.mapInArrow(_meet(s.cosine, dim, kind), "id long, links long, low long"), "met")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """One row per input row: id_col, n_links, component_id, kept.

    A link is a pair of vectors of one length found in a common leaf with a cosine of at least settings.cosine;
    n_links counts the other rows linked directly, component_id is the smallest id reachable, kept marks its row. Rows
    whose vector is null, empty, zero or holds null or non-finite components link with nothing. Equal vectors are one
    class, which is routed once: repeated rows link with each other and share their result. Rows with a null id are
    kept, have a null component_id and count in others' n_links. Other columns are not read; empty tables give empty
    ones. Every length of vectors is searched by itself: one forest for each of the commonest, and for rarer ones a
    leaf that is compared whole.
    """
    s = settings or Settings()
    spark = vectors.sparkSession
    ship(spark)
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    two = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    rows = stored(two.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(7), "vector"), "n": F.when(_valid("vector"), F.size("vector"))}), "vectors")
    good = rows.where("n IS NOT NULL")
    classes = good.groupBy("h1", "h2", "n").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("node", F.coalesce("id", F.expr("shiftrightunsigned(h1, 2) | 4611686018427387904L"))), "classes")
    common = classes.groupBy("n").agg(F.count("*").alias("rows")).where("rows > 1").orderBy(F.desc("rows"), "n")
    found = None
    for k, r in enumerate(common.toLocalIterator()):  # a row for each length
        part = _links(classes.where(F.col("n") == r.n), r.n, r.rows, k < s.lengths, s)
        found = part if found is None else found.unionByName(part)
    named = classes.select("h1", "h2", "n", "node", "copies")
    if found is not None:
        label = stored(connected_components(found.select("low", "id"), ("low", "id")), "labels").withColumnRenamed("id", "node")
        counted = found.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
        named = named.join(counted, "node", "left").join(label, "node", "left")
    else:
        named = named.withColumns({"links": F.lit(0).cast("long"), "component": F.col("node")})
    out = rows.drop("vector").join(stored(named, "named"), ["h1", "h2", "n"], "left")
    fine = F.col("n").isNotNull()
    links = F.when(fine, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long")
    component = F.when(F.col("id").isNotNull(), F.when(fine, F.coalesce("component", "node")).otherwise(F.col("id")))
    out = out.select("id", links.alias("n_links"), component.alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _valid(column: str):
    """Whether a vector has a direction: no null or non-finite component, and one that is not zero."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(column, lambda x: x != 0.0), F.lit(False))
