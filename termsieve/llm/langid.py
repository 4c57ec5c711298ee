"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of white space become one space, and n-grams of code points are hashed. A feature is
the n-gram's share of the text times its idf, which is counted over all rows that may be learnt from. Weights are
trained on a bounded sample by follow-the-regularised-leader with L1 and L2 penalties; a temperature fitted on
part of the sample that training did not see calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsieve.llm.runtime import ship, stored, summed, tidied
from termsieve.llm.toxicity import remainder

U32 = np.uint32
ODD = (U32(0x9E3779B1), U32(0x85EBCA6B), U32(0xC2B2AE35))
UNKNOWN = "und"
#: Code points handled at once; a longer text is a block of its own.
BLOCK = 1 << 18


@dataclass(frozen=True)
class Settings:
    """orders of n-grams, hashed to 2**bits features. sample: rows learnt from at most, shared out evenly over the
    languages as far as they reach, a fifth of them for the temperature. alpha, beta: learning rate of each coordinate; l1, l2: penalties; passes over the sample.
    """

    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 15
    sample: int = 3000
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01
    passes: int = 4
    scale: float = 25.0


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, code points, end of each text): every text as ' words between single spaces ' + NUL."""
    held, first, size = [], 0, 0
    for i, t in enumerate(texts):
        clean = f" {' '.join((t or '').lower().split())} \0"
        if held and size + len(clean) > BLOCK:
            yield first, *_points(held)
            held, first, size = [], i, 0
        held.append(clean)
        size += len(clean)
    if held:
        yield first, *_points(held)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), U32)
    return data, np.cumsum([len(t) for t in texts])


def grams(data: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the first code point, feature) of all n-grams that lie within one text, by order."""
    zero = data == 0
    for n in s.orders:
        total = len(data) - n + 1
        if total <= 0:
            continue
        h = np.full(total, U32(n * 0x2545F491 & 0xFFFFFFFF))
        bad = np.zeros(total, bool)
        for j in range(n):
            h = (h ^ data[j : j + total]) * ODD[j % 3]
            h ^= h >> U32(15)
            bad |= zero[j : j + total]
        at = np.flatnonzero(~bad)
        yield at, (h[at] >> U32(32 - s.bits)).astype(np.int64)


def _presence(s: Settings):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(1 << s.bits, np.int64), 0
        for batch in batches:
            for _, data, ends in _blocks(batch.column(0).to_pylist()):
                owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                for a in range(0, len(ends), 256):
                    lo, hi = (ends[a - 1] if a else 0), ends[min(a + 256, len(ends)) - 1]
                    seen = np.zeros((min(256, len(ends) - a), 1 << s.bits), bool)
                    for at, f in grams(data[lo:hi], s):
                        seen[owner[lo + at] - a, f] = True
                    df += seen.sum(0)
                rows += len(ends)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([df.astype("<i8").tobytes()], pa.binary())], ["rows", "df"])

    return run


def document_frequencies(texts: DataFrame, s: Settings) -> tuple[int, np.ndarray]:
    """Rows, and rows that hold each feature, over all of `texts`: a vector per partition, added up by a tree of tasks."""
    rows, df = summed(texts.mapInArrow(_presence(s), "rows long, df binary"))
    return rows, np.zeros(1 << s.bits, np.int64) if df is None else df


def _counts(s: Settings):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, ends in _blocks(batch.column(2).to_pylist()):
                ids, counts = [], []
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    f = [f for _, f in grams(data[a:b], s)]
                    i, c = np.unique(np.concatenate(f), return_counts=True)
                    ids.append(i.astype("<i4").tobytes())
                    counts.append(c.astype("<i4").tobytes())
                part = batch.slice(first, len(ends))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["id", "lang", "f", "n"])

    return run


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: list[int], classes: int, s: Settings) -> np.ndarray:
    """Weights (features + bias) x classes by per-coordinate FTRL-proximal."""
    size = (1 << s.bits) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(idx):
        zi, ni = z[idx], n[idx]
        w = -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= s.l1, 0.0, w)

    rng = np.random.default_rng(5)
    for _ in range(s.passes):
        for k in rng.permutation(len(rows)).tolist():
            idx, x = rows[k]
            w = weights(idx)
            p = softmax((x @ w)[None])[0]
            p[y[k]] -= 1
            g = x[:, None] * p[None]
            ni = n[idx]
            after = ni + g * g
            z[idx] += g - (np.sqrt(after) - np.sqrt(ni)) / s.alpha * w
            n[idx] = after
    return weights(np.arange(size))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that gives the least log loss, between 0.05 and 20, by golden section.

    The targets are smoothed by one row for each class, so that a sample without an error does not give certainty.
    """
    if not len(y):
        return 1.0
    soft = np.full(logits.shape, 1.0 / (len(y) + logits.shape[1]))
    soft[np.arange(len(y)), y] += len(y) / (len(y) + logits.shape[1])

    def loss(t: float) -> float:
        return float(-(soft * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(1).mean())

    a, b, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _sums(table: np.ndarray, f: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The rows' sums of table[f] over stretches; a few rows of the table are gathered at a time."""
    if len(f) <= 1 << 20:
        return np.add.reduceat(table[f], start, axis=0)
    out = np.zeros((len(start), table.shape[1]))
    for k, (a, z) in enumerate(zip(start.tolist(), [*start[1:].tolist(), len(f)], strict=True)):
        for b in range(a, z, 1 << 20):
            out[k] += table[f[b : min(z, b + (1 << 20))]].sum(0)
    return out


def sample_rates(counts: list, sample: int) -> dict[str, float]:
    """The share of each language's rows (lang, count) to learn from: equal numbers, the rest of small ones shared again."""
    left, rates = sample, {}
    order = sorted(((r["count"], r["lang"]) for r in counts))
    for k, (n, lang) in enumerate(order):
        quota = min(n, max(1, left // (len(order) - k)))
        rates[lang] = quota / n
        left -= quota
    return rates


def _predict(shared, s: Settings):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, bias, heat = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found, sure = [], []
            for first, data, ends in _blocks(texts):
                if langs:
                    logits = np.zeros((len(ends), len(langs)))
                    total = np.zeros(len(ends))
                    for at, f in grams(data, s):
                        start = np.searchsorted(at, np.concatenate(([0], ends[:-1])))
                        full = np.flatnonzero(np.diff(np.concatenate((start, [len(at)]))))
                        logits[full] += _sums(table, f, start[full])
                        total += np.diff(np.concatenate((start, [len(at)])))
                    p = softmax((logits / np.maximum(total, 1)[:, None] + bias) / heat)
                for k in range(len(ends)):
                    letter = next((True for c in texts[first + k] or "" if c.isalpha()), False)
                    best = int(p[k].argmax()) if langs and letter else -1
                    found.append(langs[best] if best >= 0 else UNKNOWN)
                    sure.append(float(min(1.0, p[k, best])) if best >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(sure, pa.float64())], ["id", "lang_pred", "score"])

    return run


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               fold: int = 4, held: int = 2, settings: Settings | None = None) -> DataFrame:
    """One row per input row: id_col, held_out, lang_pred, score.

    Learns from text and non-null language of rows whose crc32 of the id as text modulo `fold` is not `held`;
    predictions read the text alone, whole. Texts that are null or have no letter are `und` with score 0, and so
    is everything where there is nothing to learn from. A null id is neither held out nor learnt from. Repeated rows
    are learnt from and predicted as often as they come. Other columns are not read; an empty table gives an empty one.
    Document frequencies are counted over all rows that may be learnt from; one row per language comes to the driver.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    ship(spark)
    three = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    own = three.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("id", fold) != held))
    rates = sample_rates(own.groupBy("lang").count().collect(), s.sample)  # a row per language
    total, df = document_frequencies(own.select("text"), s)
    idf = np.append(np.log((1 + total) / (1 + df)) + 1, 0.0)
    lot = F.pmod(F.xxhash64(F.lit(23), "id"), F.lit(1 << 30))
    share = F.broadcast(spark.createDataFrame(list(rates.items()), "_lang string, _rate double"))
    few = own.join(share, F.col("lang") == F.col("_lang")).where(lot < F.col("_rate") * F.lit(float(1 << 30))).select("id", "lang", "text")
    few = stored(few.mapInArrow(_counts(s), "id long, lang string, f binary, n binary"), "sample")
    rows = few.orderBy(F.xxhash64(F.lit(29), "id"), "id", "lang").limit(s.sample).collect()
    langs = sorted({r.lang for r in rows})
    examples, y = [], []
    for r in rows:
        f, c = np.frombuffer(bytes(r.f), "<i4").astype(np.int64), np.frombuffer(bytes(r.n), "<i4")
        examples.append((np.append(f, 1 << s.bits), np.append(s.scale * c / max(1, c.sum()) * idf[f], 1.0)))
        y.append(langs.index(r.lang))
    learn = [k for k in range(len(rows)) if k % 5 or len(rows) < 50]
    w = train([examples[k] for k in learn], [y[k] for k in learn], len(langs), s) if langs else np.zeros(((1 << s.bits) + 1, 0))
    rest = [k for k in range(len(rows)) if k % 5 == 0 and len(rows) >= 50]
    heat = temperature(np.array([examples[k][1] @ w[examples[k][0]] for k in rest]), np.array([y[k] for k in rest], np.int64)) if rest else 1.0
    table = (s.scale * idf[:-1, None] * w[:-1]).astype(np.float32)
    shared = spark.sparkContext.broadcast((langs, table, w[-1], heat))
    out = three.select("id", "text").mapInArrow(_predict(shared, s), "id long, lang_pred string, score double")
    held_out = F.coalesce(remainder("id", fold) == held, F.lit(False))
    return out.select(F.col("id").alias(id_col), held_out.alias("held_out"), "lang_pred", "score")
