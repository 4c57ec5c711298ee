"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and byte prefixes of words: all that two or more of the labelled rows hold, but for stop words, which
too many of all documents hold. A term weighs
(1 + log of its count) times its idf over all documents, times its relevance: what the labelled rows tell about the
term, above a floor that every term keeps. The examples' vectors are kept in an inverted index in blocks, with each
term's largest weight in every block: a query adds those maxima up, scores the blocks with the highest bounds, and
then those whose bound reaches its k-th best example. Votes are calibrated on examples that neither the relevance nor
the index they are scored with has seen.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm import text as T
from termsieve.llm.idfilter import without_rows
from termsieve.llm.runtime import ship, stored, summed, tidied

PREFIXES = (4, 6)
PART = np.array([not chr(b).isalnum() if b < 128 else False for b in range(256)])
TAG = T.STEP[:8]
#: Bytes of texts whose terms are counted at once.
BLOCK = 1 << 18


@dataclass(frozen=True)
class Settings:
    """sample: labelled rows learnt from at most. k: neighbours that vote. block: examples of an index block.
    stop: share of all documents (10 of them at least) beyond which a term is a stop word.

    floor: relevance that every term has; doubt: deviations that a term's share among toxic examples must stand out by
    before it has more. prior: weight of the vote for the rate among examples without any term. folds: parts of the
    examples that are scored with the others' terms and votes for the calibration.
    """

    sample: int = 4000
    k: int = 7
    block: int = 64
    stop: float = 0.3
    floor: float = 0.05
    doubt: float = 2.0
    prior: float = 0.5
    folds: int = 4
    threshold: float = 0.7


def _word_terms(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words x terms, word of each occurrence, text of each occurrence); 0 stands for no term.

    Words are runs of ASCII letters, digits and any non-ASCII characters. A word's terms are its prefixes of 4 and 6
    bytes if they are shorter than it, and the word.
    """
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inside = ~PART[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    up, down = T.powers(len(data) + 1)
    total = np.empty(len(data) + 1, T.U64)
    total[0] = 0
    np.cumsum(T.BYTE[data] * up[: len(data)], out=total[1:])
    words, first, word = np.unique(T.mix((total[ends] - total[starts]) * down[starts]), return_index=True, return_inverse=True)
    starts, size = starts[first], (ends - starts)[first]
    terms = np.zeros((len(words), len(PREFIXES) + 1), T.U64)
    for k, n in enumerate(PREFIXES):
        at = starts[long := np.flatnonzero(size > n)]
        terms[long, k] = T.mix((total[at + n] - total[at]) * down[at]) ^ TAG[k]
    terms[:, -1] = words ^ TAG[7]
    return terms, word, owner


class Lookup:
    """Places of 64-bit hashes in an array, by linear probing in a table."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.slots = np.full(1 << max(4, (3 * len(keys)).bit_length()), -1, np.int32)
        left, step = np.arange(len(keys)), 0
        while len(left):
            spot = self._spot(keys[left], step)
            free = self.slots[spot] < 0
            spot, first = np.unique(spot[free], return_index=True)
            self.slots[spot] = left[free][first]
            left, step = left[self.slots[self._spot(keys[left], step)] != left], step + 1

    def _spot(self, hashes: np.ndarray, step: int) -> np.ndarray:
        return ((hashes + T.U64(step)) & T.U64(len(self.slots) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out, left, step = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        while len(left):
            slot = self.slots[self._spot(hashes[left], step)]
            full = slot >= 0
            left, slot, step = left[full], slot[full], step + 1
            hit = self.keys[slot] == hashes[left]
            out[left[hit]] = slot[hit]
            left = left[~hit]
        return out


def counted(raw: list[bytes], lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the known terms, in order; a long text is counted a segment at a time."""
    if not len(lookup.keys):
        return (np.empty(0, np.int64),) * 3
    if len(raw) == 1 and len(raw[0]) > 2 * BLOCK:
        parts = [counted_block([part], lookup) for part in T.segments(raw[0], BLOCK)]
        term, place = np.unique(np.concatenate([t for _, t, _ in parts]), return_inverse=True)
        n = np.bincount(place, np.concatenate([c for _, _, c in parts]), len(term)).astype(np.int64)
        return np.zeros(len(term), np.int64), term, n
    return counted_block(raw, lookup)


def counted_block(raw: list[bytes], lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms, word, owner = _word_terms(raw)
    known = np.where(terms != 0, lookup.find(terms.ravel()).reshape(terms.shape), -1)
    every = known[word]
    key = (owner[:, None] * len(lookup.keys) + every)[every >= 0]
    key, n = np.unique(key, return_counts=True)
    return key // len(lookup.keys), key % len(lookup.keys), n


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, examples) of each run of texts."""
    for batch in batches:
        for raw in T.batches(T.utf8(batch.column(0)), BLOCK):
            low = [r.lower() for r in raw]
            parts = [_word_terms([x]) for x in T.segments(low[0], BLOCK)] if len(low) == 1 and len(low[0]) > 2 * BLOCK else [_word_terms(low)]
            pair = [np.stack((t[w].ravel(), np.repeat(o, t.shape[1]).astype(T.U64)), 1) for t, w, o in parts]
            pair = np.unique(np.concatenate(pair), axis=0) if sum(map(len, pair)) else np.empty((0, 2), T.U64)
            term, n = np.unique(pair[pair[:, 0] != 0, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])


def vocabulary(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms that two labelled rows hold or more (of a single row: all)."""
    least = 2 if sample.count() > 1 else 1
    terms = sample.select("text").mapInArrow(_labelled, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = terms.select("term").toArrow().column(0)  # terms of the bounded sample
    return np.sort(rows.to_numpy().view(T.U64)) if len(rows) else np.empty(0, T.U64)


def _frequencies(shared):
    """Texts, and texts that hold each term, of a whole partition."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, rows = shared.value, 0
        df = np.zeros(len(lookup.keys), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for _, raw in T.blocks(T.utf8(batch.column(0)), BLOCK):
                df += np.bincount(counted(raw, lookup)[1], minlength=len(df))
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([df.astype("<i8").tobytes()], pa.binary())], ["rows", "df"])

    return run


def _vectors(shared):
    """(id, terms, counts) as bytes of 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw in T.blocks(T.utf8(batch.column(1)), BLOCK):
                owner, term, n = counted(raw, shared.value)
                at = np.searchsorted(owner, np.arange(len(raw) + 1)).tolist()
                cut = lambda x, at=at: pa.array([x[a:z].astype("<i4").tobytes() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raw)), cut(term), cut(n)], ["id", "terms", "counts"])

    return run


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several stretches in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class BlockMaxIndex:
    """Unit vectors of examples as postings by term, cut into stretches of one block with the stretch's maximum.

    The longest lists, each held by a sixty-fourth of the examples or more, are kept as dense rows instead, which score
    many queries at once; they come first, and the blocks' bounds start from what they gave.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int, dense: int = 1024) -> None:
        chief = [int(t[w.argmax()]) if len(t) else -1 for t, w in vectors]  # examples with the same chief term share blocks
        self.order, self.block = np.argsort(chief, kind="stable").astype(np.int32), block
        self.blocks = max(1, -(-len(vectors) // block))
        nothing = [np.empty(0, np.int64)]
        t = np.concatenate([vectors[i][0] for i in self.order] or nothing)
        w = np.concatenate([vectors[i][1] for i in self.order] or nothing).astype(np.float32)
        e = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(vectors[i][0]) for i in self.order])
        length = np.bincount(t, minlength=n_terms)
        long = np.argsort(-length, kind="stable")[:dense]
        long = long[length[long] >= max(1, len(vectors) / 64)]
        self.row = np.full(n_terms, -1, np.int32)
        self.row[long] = np.arange(len(long))
        self.dense = np.zeros((len(long), self.blocks * block), np.float32)
        there = self.row[t] >= 0
        self.dense[self.row[t[there]], e[there]] = w[there]
        t, w, e = t[~there], w[~there], e[~there]
        by = np.argsort(t, kind="stable")
        t, self.weights, self.examples = t[by], w[by], e[by]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (self.examples[1:] // block != self.examples[:-1] // block)
        start = np.flatnonzero(new)
        self.starts = np.append(start, len(t)).astype(np.int32)
        self.where = (self.examples[start] // block).astype(np.int32)
        self.top = np.maximum.reduceat(self.weights, start) if len(start) else np.empty(0, np.float32)
        self.first = np.searchsorted(t[start], np.arange(n_terms + 1)).astype(np.int32)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """For each query the k examples of the highest cosine above 0, exactly; ties go to the one first in block order."""
        out = []
        for a in range(0, len(queries), 64):
            part = queries[a : a + 64]
            q = np.zeros((len(part), len(self.dense)), np.float32)
            for n, (t, w) in enumerate(part):
                row = self.row[t]
                q[n, row[row >= 0]] = w[row >= 0]
            out += [self._nearest(t, w, score, k) for (t, w), score in zip(part, q @ self.dense, strict=True)]
        return out

    def _nearest(self, terms: np.ndarray, weights: np.ndarray, score: np.ndarray, k: int) -> list[tuple[float, int]]:
        """score: what the dense rows gave each example."""
        rest = self.row[terms] < 0
        terms, weights = terms[rest], weights[rest]
        sizes = (self.first[terms + 1] - self.first[terms]).astype(np.int64)
        every, w = _spread(self.first[terms].astype(np.int64), sizes), np.repeat(weights, sizes)
        where = self.where[every]
        best = score.reshape(self.blocks, self.block).max(1)
        bound = best + np.bincount(where, w * self.top[every], self.blocks)
        least = np.partition(score, -k)[-k] if len(score) > k else 0.0
        some = (bound > 0) & (bound >= least - 1e-6)  # no other block holds one of the k best
        hit = some[where]
        every, w = every[hit], w[hit]
        sizes = (self.starts[every + 1] - self.starts[every]).astype(np.int64)
        at = _spread(self.starts[every].astype(np.int64), sizes)
        total = score + np.bincount(self.examples[at], np.repeat(w, sizes) * self.weights[at], len(score))
        near = np.flatnonzero((total > 0) & (total >= least - 1e-6))
        near = near[some[near // self.block]]
        near = near[np.lexsort((near, -total[near]))[:k]]
        return [(float(total[i]), int(self.order[i])) for i in near]


Example = tuple[int | None, np.ndarray, np.ndarray, int]


def relevance(examples: list[Example], n_terms: int, s: Settings) -> np.ndarray:
    """How much a term speaks for the label: the signed root of its likelihood ratio among toxic examples, less doubt."""
    count = lambda label: np.bincount(np.concatenate([t for _, t, _, y in examples if y == label] or [np.empty(0, np.int64)]), minlength=n_terms)
    toxic = sum(y for *_, y in examples)
    pos, neg, other = count(1), count(0), len(examples) - toxic
    ratio = np.log(((pos + 0.5) / (toxic + 1)) / ((neg + 0.5) / (other + 1)))
    return (s.floor + np.maximum(0, np.sqrt(2 * pos * np.maximum(0, ratio)) - s.doubt)).astype(np.float32)


class Votes:
    """Examples' index with labels and the weights of terms: what a text's vote comes from."""

    def __init__(self, examples: list[Example], idf: np.ndarray, s: Settings) -> None:
        self.s = s
        self.weight = (idf * relevance(examples, len(idf), s)).astype(np.float32)
        full = [x for x in examples if len(x[1])]
        self.ids, self.labels = [x[0] for x in full], np.array([x[3] for x in full], float)
        self.index = BlockMaxIndex([(x[1], self.unit(x[1], x[2])) for x in full], len(idf), s.block)
        empty = [x[3] for x in examples if not len(x[1])]
        self.rate = (sum(empty) + 0.5) / (len(empty) + 1.0) if examples else 0.0

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.weight[terms]
        return w / (np.sqrt(w @ w) or 1.0)

    def votes(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[tuple[float, int]]]]:
        """The distance-weighted share of toxic neighbours of each text (terms, counts), and the neighbours."""
        found = self.index.nearest([(t, self.unit(t, n)) for t, n in texts], self.s.k) if len(self.ids) else [[] for _ in texts]
        out = []
        for near in found:
            up, down = self.s.prior * self.rate, self.s.prior
            for c, i in near:
                w = 1.0 / (1.05 - min(1.0, c))
                up += w * self.labels[i]
                down += w
            out.append((up / down, near))
        return out


class Model:
    """Votes of all examples, and the calibration that parts of them give."""

    def __init__(self, examples: list[Example], idf: np.ndarray, s: Settings) -> None:
        self.votes = Votes(examples, idf, s)
        votes, labels = [], []
        for f in range(s.folds if len(examples) >= 2 * s.folds else 0):
            others = Votes([x for k, x in enumerate(examples) if k % s.folds != f], idf, s)
            own = examples[f :: s.folds]
            votes += [v for v, _ in others.votes([(t, n) for _, t, n, _ in own])]
            labels += [y for *_, y in own]
        self.line = _platt(np.array(votes), np.array(labels, float))

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[tuple[float, int]]]]:
        return [(self.calibrated(vote), near) for vote, near in self.votes.votes(texts)]

    def calibrated(self, vote: float) -> float:
        if self.line is None:
            return min(1.0, max(0.0, vote))
        z = self.line[0] * _logit(vote) + self.line[1]
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _platt(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float] | None:
    """Slope and offset of the logistic calibration with smoothed targets; None where one label is missing."""
    pos, neg = labels.sum(), len(labels) - labels.sum()
    if not pos or not neg:
        return None
    x, y = _logit(votes), np.where(labels > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(t: np.ndarray) -> float:
        z = t[0] * x + t[1]
        return float((np.logaddexp(0, z) - y * z).sum() + 5e-4 * t[0] ** 2)

    t = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(t[0] * x + t[1], -500, 500)))
        g = np.array([((p - y) * x).sum() + 1e-3 * t[0], (p - y).sum()])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step, size, now = np.linalg.solve(h, g), 1.0, loss(t)
        while size > 1e-6 and loss(t - size * step) > now:
            size /= 2
        t = t - size * step
        if abs(size * step).max() < 1e-8:
            break
    return (float(t[0]), float(t[1])) if t[0] > 0 else None


#: Texts whose answers a task remembers, for copies.
REMEMBERED = 2000


def _score(words, shared, evidence: bool):
    kind = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        ids, labels = model.votes.ids, model.votes.labels
        known: dict[bytes, tuple[float, list]] = {}
        for batch in batches:
            for first, raw in T.blocks(T.utf8(batch.column(2)), BLOCK):
                owner, term, n = counted(raw, words.value)
                at = np.searchsorted(owner, np.arange(len(raw) + 1)).tolist()
                texts = [(term[a:z], n[a:z]) for a, z in zip(at[:-1], at[1:], strict=True)]
                keys = [hashlib.blake2b(t.tobytes() + c.tobytes(), digest_size=16).digest() for t, c in texts]
                fresh = dict(zip(reversed(keys), reversed(texts), strict=True))
                if len(known) >= REMEMBERED:
                    known.clear()
                fresh = {x: y for x, y in fresh.items() if x not in known}
                for x, (score, near) in zip(fresh, model.scores(list(fresh.values())), strict=True):
                    known[x] = score, [{"id": ids[i], "cosine": min(1.0, c), "toxic": int(labels[i])} for c, i in near] if evidence else None
                found = [known[x] for x in keys]
                part = batch.slice(first, len(raw))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x for x, _ in found], pa.float64()), pa.array([x for _, x in found], kind)], ["id", "mark", "score", "evidence"])

    return run


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(by)


def fitted(docs: DataFrame, labels: DataFrame, s: Settings, fold: int, held: int) -> tuple[Lookup, Model]:
    """Vocabulary and model out of docs (id, text) and labels (id, toxic)."""
    spark = docs.sparkSession
    own = labels.where("id is not null and toxic is not null").where(remainder("id", fold) != held).groupBy("id").agg(F.max("toxic").alias("toxic"))
    lot = F.pmod(F.xxhash64(F.lit(31), "id"), F.lit(1 << 30))
    n = own.count()
    if n > s.sample:
        own = own.where(lot < F.lit(int((1 << 30) * s.sample / n)))
    small = spark.createDataFrame(own.orderBy(lot, "id").limit(s.sample).toPandas().astype("int64"), "id long, toxic long")  # `sample` rows
    sample = stored(docs.join(F.broadcast(small), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")), "labelled")
    words = Lookup(vocabulary(sample))
    shared = spark.sparkContext.broadcast(words)
    total, df = summed(docs.select("text").mapInArrow(_frequencies(shared), "rows long, df binary"))
    df = np.zeros(len(words.keys), np.int64) if df is None else df
    kept = df <= max(s.stop * total, 10)
    words, idf = Lookup(words.keys[kept]), np.log((1 + total) / np.maximum(df[kept], 1))
    shared.destroy()
    shared = spark.sparkContext.broadcast(words)
    read = lambda x: np.frombuffer(bytes(x), "<i4").astype(np.int64)
    vectors = sample.select("id", "text").mapInArrow(_vectors(shared), "id long, terms binary, counts binary").join(F.broadcast(small), "id").orderBy("id")
    examples = [(r.id, read(r.terms), read(r.counts), int(r.toxic > 0)) for r in vectors.toLocalIterator()]  # `sample` rows
    shared.destroy()
    return words, Model(examples, idf, s)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           fold: int = 3, held: int = 1, settings: Settings | None = None, evidence: bool = True) -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted, evidence, text_hash.

    Labels are learnt only from ids whose crc32 modulo `fold` is not `held`; scores read the text alone. Of repeated
    labels the largest counts, null ones none; of an id's texts the least is learnt from; a null id is not held out and
    has no label. Texts without terms, null and empty ones included, get the calibrated rate of such examples. Without
    labels every score is 0. evidence lists the nearest examples with their cosine and label (null if it isn't asked
    for); text_hash tells rows of one id apart. The sample is bounded by the settings, and with it what passes through
    the driver: its terms, its vectors and their index. Everything else is computed over all documents where they lie.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    ship(spark)
    text = F.col(text_col).cast("string")
    three = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    words, model = (spark.sparkContext.broadcast(x) for x in fitted(three.select("id", "text"), own, s, fold, held))
    out = three.mapInArrow(_score(words, model, evidence), "id long, mark long, score double, evidence array<struct<id:long,cosine:double,toxic:int>>")
    held_out = F.coalesce(remainder("id", fold) == held, F.lit(False))
    return out.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted"), "evidence", F.col("mark").alias("text_hash"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns; each by its own text, whatever its id."""
    rows = scored(docs, labels, id_col, text_col, settings=settings, evidence=False).where("predicted = 1")
    return without_rows(docs, id_col, F.xxhash64(F.col(text_col).cast("string")), rows.select(F.col(id_col).alias("id"), F.col("text_hash").alias("mark")))
