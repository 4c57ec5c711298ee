"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents are shuffled by a hash and laid end to end; that line of words is cut into blocks of equal
size. Slot n of the mix takes the point frac(n * golden ratio), mapped through the cumulative target shares to a
source; the k-th slot of a source takes its k-th block, starting over after the last one. A source of fewer than
FEW such blocks is too small for slots of the common size: it has FEW smaller blocks or more, and takes as many as its
target holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsieve.llm.runtime import stored

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
#: Rows of one window: documents of a source's hash bucket, slots of a stretch of the schedule.
RUN = 1024
#: Blocks below which a source gets a block size of its own.
FEW = 1024


@dataclass(frozen=True)
class Settings:
    """weights repeat over the sources in code point order, null last. A source gives `most` times its size at most.

    A mix has about `slots` blocks until blocks reach `largest` words; from there on the number of blocks grows.
    """

    weights: Sequence[float] = (1, 2, 3)
    most: int = 3
    slots: int = 65536
    largest: int = 4096
    seed: int = 17


def targets(sizes: Sequence[tuple[str | None, int]], s: Settings) -> list[tuple[str | None, int, float]]:
    """(source, size, target): the total shared by weight, cut at `most` sizes, the excess shared again."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = [float(s.weights[i % len(s.weights)]) for i in range(len(order))]
    target, free, left = [0.0] * len(order), [i for i, (_, n) in enumerate(order) if n], float(sum(n for _, n in order))
    while free:
        share = left / sum(weight[i] for i in free)
        over = [i for i in free if share * weight[i] > s.most * order[i][1]]
        if not over:
            for i in free:
                target[i] = share * weight[i]
            break
        for i in over:
            target[i] = float(s.most * order[i][1])
            left -= target[i]
        free = [i for i in free if i not in set(over)]
    return [(name, n, t) for (name, n), t in zip(order, target, strict=True)]


def golden_points(n: Column) -> Column:
    """frac(n * GOLDEN) in halves of n, so that it stays exact enough for n up to 2**40."""
    high = F.floor(n / F.lit(1 << 20))
    step = (1 << 20) * GOLDEN % 1.0
    x = high * F.lit(step) + (n - high * F.lit(1 << 20)) * F.lit(GOLDEN)
    return x - F.floor(x)


def schedule(df_session, plan: Sequence[tuple[str | None, int, float]], block: int, most: int) -> DataFrame:
    """(slot, part, rank, block, epoch): which block of which source (by its place in the plan) each slot takes.

    Slots of one source beyond `most` whole passes are left out. Ranks come from counts of stretches of the
    schedule plus a rank inside the stretch, so no window holds all slots of a source.
    """
    total = sum(t for _, _, t in plan)
    slots = -(-int(round(total)) // block)
    edges, sofar = [], 0.0
    for _, _, t in plan:
        sofar += t
        edges.append(sofar / total if total else 1.0)
    last = max((i for i, (_, _, t) in enumerate(plan) if t), default=0)
    cut = F.array(*[F.lit(e) for e in edges[:last]]) if last else F.array().cast("array<double>")
    part = F.size(F.filter(cut, lambda e: e <= F.col("point")))
    slot = df_session.range(slots).select(F.col("id").alias("slot"), golden_points(F.col("id")).alias("point"))
    slot = slot.select("slot", part.alias("part"), F.floor(F.col("slot") / (4 * RUN)).alias("stretch"))
    counts = slot.groupBy("part", "stretch").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)))
    inside = slot.withColumn("inside", F.row_number().over(Window.partitionBy("part", "stretch").orderBy("slot")) - 1)
    ranked = inside.join(before.select("part", "stretch", "before"), ["part", "stretch"])
    ranked = ranked.select("slot", "part", (F.coalesce("before", F.lit(0)) + F.col("inside")).alias("rank"))
    blocks = F.element_at(F.array(*[F.lit(max(1, -(-n // block))).cast("long") for _, n, _ in plan]), F.col("part") + 1)
    ranked = ranked.withColumn("blocks", blocks).where(F.col("rank") < F.col("blocks") * most)
    return ranked.select("slot", "part", "rank", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("epoch"))


@dataclass
class _Mix:
    """What mixed() and mix() work on: sizes of the rows with their source's plan, places, and uses of the blocks."""

    plan: list[tuple[str | None, int, float]]
    grains: list[int]
    buckets: int
    rows: DataFrame
    starts: DataFrame
    placed: DataFrame
    times: DataFrame


def _bucket(id_column: Column, buckets: int, s: Settings) -> Column:
    """A document's stretch of its source's shuffled line."""
    return F.pmod(F.xxhash64(F.lit(s.seed), id_column), F.lit(buckets))


def _lay_out(docs: DataFrame, id_col: str, text_col: str, source_col: str, s: Settings) -> _Mix:
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    rows = stored(rows.withColumn("h", F.xxhash64(F.lit(s.seed), "id")), "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    plan = targets([(r.source, r.n) for r in per], s)
    total = sum(n for _, n, _ in plan)
    block = max(1, min(s.largest, total // s.slots))
    grains = [block if n >= FEW * block else max(1, n // FEW) for _, n, _ in plan]  # words of a block, by source
    own = [n < FEW * block for _, n, _ in plan]
    uses = [min(s.most * -(-n // g), int(round(t / g))) for (_, n, t), g in zip(plan, grains, strict=True)]
    kinds = spark.createDataFrame([(i, name, n, t, g, o, u) for i, ((name, n, t), g, o, u) in enumerate(zip(plan, grains, own, uses, strict=True))],
                                  "part int, name string, source_size long, target double, grain long, own boolean, uses long")
    near = F.broadcast(kinds) if len(plan) <= 10_000 else kinds
    rows = rows.join(near.drop("own", "uses"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    buckets = max(1, -(-sum(r.rows for r in per) // RUN))
    full = rows.where("size > 0").withColumn("bucket", _bucket(F.col("id"), buckets, s))
    sums = full.groupBy("part", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(sums.withColumn("before", F.coalesce(before, F.lit(0))), "bucket-starts")
    order = Window.partitionBy("part", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = full.withColumn("inside", F.sum("size").over(order) - F.col("size")).join(starts.select("part", "bucket", "before"), ["part", "bucket"])
    placed = placed.select("id", "size", "part", "source_size", "target", "grain", "bucket", (F.col("before") + F.col("inside")).alias("start"))
    times = schedule(spark, plan, block, s.most).groupBy("part", "block").agg(F.count("*").alias("times"))
    times = times.join(near.where("NOT own").select("part"), "part")
    small = kinds.where("own AND uses > 0").withColumn("blocks", F.expr("(source_size + grain - 1) div grain"))
    small = small.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    small = small.select("part", "block", F.expr("uses div blocks + if(block < uses % blocks, 1, 0)").alias("times")).where("times > 0")
    times = times.select("part", "block", "times").union(small)
    return _Mix(plan, grains, buckets, rows, starts, stored(placed, "placed"), stored(times, "times"))


def _taken(m: _Mix, placed: DataFrame) -> DataFrame:
    """The placed rows with taken: their pieces of blocks joined with the uses of those blocks."""
    piece = placed.withColumn("block", F.explode(F.sequence(F.expr("start div grain"), F.expr("(start + size - 1) div grain"))))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("grain")) - F.greatest("start", F.col("block") * F.col("grain"))
    used = piece.select("part", "start", "block", overlap.alias("overlap")).join(m.times, ["part", "block"])
    used = used.groupBy("part", "start").agg(F.sum(F.col("overlap") * F.col("times")).alias("taken"))
    return placed.join(stored(used, "taken"), ["part", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", settings: Settings | None = None) -> DataFrame:
    """One row per input row: id_col, size, source_size, target, taken.

    size counts words (null text: 0), target is the share of the row's source, taken the words that the mix takes,
    repeats counted: whole passes over the document plus, where the last block of its source ends inside it, its
    first words. Null is a source of its own. Repeated rows take their own places. Rows without words take 0.
    One row per source comes to the driver, nothing else. Other columns are not read.
    """
    m = _lay_out(docs, id_col, text_col, source_col, settings or Settings())
    out = _taken(m, m.placed).select("id", "size", "source_size", "target", "taken")
    none = m.rows.where("size = 0").select("id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return out.union(none).withColumnRenamed("id", id_col)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", settings: Settings | None = None) -> DataFrame:
    """The documents as the mix takes them, with their columns: a row for each pass over a document.

    A source's blocks are taken in order, so its line of documents divides at one word: what lies before it has a
    pass more than what lies behind. Rows whose bucket lies wholly on one side are repeated where they lie; only
    those of the one bucket around that word are joined with what they take. A pass that ends inside a document
    gives its first words, joined by single spaces (n_chars, if there is such a column, counts their characters).
    Documents that the mix does not reach, and those without words (null and empty texts), are left out. Null is a
    source of its own. Repeated rows of one document around that word share what they take, rounded down; rows with a
    null id are one document there. An empty table gives an empty one. No column's name matters but the three given
    and n_chars.
    """
    s = settings or Settings()
    # Numbered names inside: no column of the documents can clash with a working one.
    place = {c.lower(): f"column{i}" for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*place.values())
    own = inner.columns
    identity, text, source = (place[c.lower()] for c in (id_col, text_col, source_col))
    m = _lay_out(inner, identity, text, source, s)
    blocks = {i: max(1, -(-n // m.grains[i])) for i, (_, n, _) in enumerate(m.plan)}
    slots = {r.part: r.slots for r in m.times.groupBy("part").agg(F.sum("times").alias("slots")).collect()}  # a row per source
    cuts = [(i, name, slots.get(i, 0) // blocks[i], slots.get(i, 0) % blocks[i] * m.grains[i]) for i, (name, _, _) in enumerate(m.plan)]
    cut = docs.sparkSession.createDataFrame(cuts, "_part int, _name string, _passes long, _cut long")
    around = m.starts.join(cut, (F.col("part") == F.col("_part")) & (F.col("before") <= F.col("_cut")) & (F.col("_cut") < F.col("before") + F.col("words")))
    at = {r._part: r.bucket for r in around.select("_part", "bucket").collect()}  # at most a row per source
    cut = docs.sparkSession.createDataFrame([(*c, at.get(c[0], -1)) for c in cuts], "_part int, _name string, _passes long, _cut long, _at long")
    rows = inner.withColumn("_bucket", _bucket(F.col(identity), m.buckets, s)).join(F.broadcast(cut) if len(cuts) <= 10_000 else cut, F.col(source).eqNullSafe(F.col("_name")))
    rows = rows.where(F.col(text).rlike(WORD))
    passes = F.col("_passes") + F.when(F.col("_bucket") < F.col("_at"), 1).otherwise(0)
    whole = rows.where("_bucket <> _at").withColumn("_n", passes).where("_n > 0").withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    edge = m.placed.join(F.broadcast(cut.select("_part", "_at")) if len(cuts) <= 10_000 else cut.select("_part", "_at"), (F.col("part") == F.col("_part")) & (F.col("bucket") == F.col("_at")))
    share = _taken(m, edge.select("id", "size", "part", "source_size", "target", "grain", "start")).groupBy(F.col("id").alias("_id")).agg(
        F.expr("sum(taken) div count(*)").alias("_taken"), F.max("size").alias("_size")).where("_taken > 0")
    both = rows.where("_bucket = _at").join(stored(share, "taken"), F.col(identity).eqNullSafe(F.col("_id")))
    both = both.withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("(_taken + _size - 1) div _size"))))
    left = F.least(F.col("_size"), F.col("_taken") - (F.col("_pass") - 1) * F.col("_size"))
    words = F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)), F.lit(1), left.cast("int"))
    both = both.withColumn("_short", F.when(left < F.col("_size"), F.concat_ws(" ", words)))
    changed = {text: F.coalesce("_short", F.col(text))}
    if (n_chars := place.get("n_chars")) is not None:
        changed[n_chars] = F.coalesce(F.length("_short").cast("long"), F.col(n_chars)).cast(inner.schema[n_chars].dataType)
    parts = both.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in own])
    return whole.select(*own).union(parts).toDF(*docs.columns)
