"""Taking out or picking rows by many ids without shuffling the texts of all the others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm.runtime import free_name, ship, stored, tidied

#: Bits of a filter: 16 an id, this many at most. A full filter only lets more rows through to the exact join.
MAX_BITS = 1 << 26


def id_bits(ids: DataFrame) -> np.ndarray:
    """A one-hash Bloom filter of ids (column id) as 32-bit words; its size is bounded."""
    n = ids.count()
    bits = int(min(MAX_BITS, max(1 << 10, 1 << (16 * max(n, 1) - 1).bit_length())))
    spot = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select(F.shiftright(spot, 5).alias("w"), F.expr("1L").alias("one"), F.pmod(spot, F.lit(32)).cast("int").alias("b"))
    rows = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("v")).toArrow()  # MAX_BITS / 32 rows at most
    out = np.zeros(bits // 32, np.uint32)
    out[rows.column("w").to_numpy()] = rows.column("v").to_numpy().astype(np.uint32)
    return out


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    spot = hashes % (len(words) * 32)
    return (words[spot >> 5] >> (spot & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


def _passing(shared, place: int, held: bool):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = may_hold(shared.value, batch.column(place).to_numpy())
            few = batch.filter(pa.array(hit if held else ~hit)).select(range(place))
            if few.num_rows:
                yield few

    return run


def split(docs: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that surely have none of the ids (column id), where they lie, and those that may; null is an id."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(id_bits(ids))
    marked = docs.withColumn(free_name(docs.columns, "_h"), F.xxhash64(F.col(id_col).cast("long")))
    place = len(docs.columns)
    return marked.mapInArrow(_passing(shared, place, False), docs.schema), marked.mapInArrow(_passing(shared, place, True), docs.schema)


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows whose id is not among `gone` (column id); null ids stay, and all columns.

    Rows that the filter tells apart go on where they lie; only rows that it may hold are joined with the ids.
    """
    ids = stored(gone.select(F.col("id").cast("long")).where("id IS NOT NULL").distinct(), "gone")
    sure, maybe = split(docs, id_col, ids)
    key = free_name(docs.columns, "_gone")
    return sure.union(maybe.join(ids.withColumnRenamed("id", key), F.col(id_col) == F.col(key), "left_anti"))


def without_rows(docs: DataFrame, id_col: str, mark: Column, gone: DataFrame) -> DataFrame:
    """The rows that are not among `gone` (columns id and mark), with all columns; null ids are compared like others.

    mark is a function of the row, which tells rows of one id apart; it is computed for rows with such an id alone.
    """
    rows = stored(gone.select(F.col("id").cast("long"), "mark").distinct(), "gone")
    sure, maybe = split(docs, id_col, rows.select("id"))
    names = [free_name(docs.columns, c) for c in ("_gone", "_mark")]
    some = maybe.withColumn(free_name([*docs.columns, *names], "_own"), mark)
    there = F.col(id_col).cast("long").eqNullSafe(F.col(names[0])) & (F.col(some.columns[-1]) == F.col(names[1]))
    return sure.union(some.join(rows.toDF(*names), there, "left_anti").select(*docs.columns))
