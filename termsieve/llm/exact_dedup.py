"""Exact duplicates by a cuckoo-filter index over content digests.

The index is sharded by digest. A shard holds a cuckoo filter of 16-bit tags whose slots lead to stored entries;
a tag that matches is verified against the entry's whole digest, and a table that overflows is rebuilt at twice
the size from the stored keys. Each input partition first folds its own rows through an index of its own, so a
text that is copied very often reaches its shard once per partition.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm.idfilter import split, without_rows
from termsieve.llm.runtime import free_name, ship, shuffle_partitions, stored, tidied
from termsieve.llm.text import utf8

SLOTS = 4
#: Entries that a task's own index holds before it hands them on, and that a shard is sized for.
FOLD, SHARD = 200_000, 200_000


class CuckooIndex:
    """Live keys (digests of at least 16 bytes) with a value each, found through a cuckoo filter.

    A key has two buckets of four slots, i and i xor hash(tag); a slot is a tag and its entry. Insertion moves
    entries between their buckets when both are full, at most `kicks` times, and then doubles the table.
    """

    def __init__(self, buckets: int = 1024, kicks: int = 64) -> None:
        self.kicks = kicks
        self.live = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = [0] * (buckets * SLOTS)
        self.entries: list[list | None] = [None] * (buckets * SLOTS)

    def _place(self, key: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(key[:8], "little")
        tag = (h >> 48) or 1
        first = h & self.mask
        return tag, first, first ^ (tag * 0x5BD1E995 & self.mask)

    def _slot(self, key: bytes) -> int:
        tag, first, second = self._place(key)
        tags = self.tags
        for bucket in (first, second):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if tags[s] == tag and self.entries[s][0] == key:  # type: ignore[index]
                    return s
        return -1

    def may_contain(self, key: bytes) -> bool:
        """The filter's answer alone, which errs on one side."""
        tag, first, second = self._place(key)
        return tag in self.tags[first * SLOTS : first * SLOTS + SLOTS] or tag in self.tags[second * SLOTS : second * SLOTS + SLOTS]

    def get(self, key: bytes) -> list | None:
        """The verified entry [key, *value] of a live key."""
        s = self._slot(key)
        return None if s < 0 else self.entries[s]

    def insert(self, entry: list) -> None:
        """Adds an entry whose key is not live yet."""
        if not self._put(entry):
            self._grow(entry)
        self.live += 1

    def _put(self, entry: list) -> bool:
        tag, first, second = self._place(entry[0])
        tags, entries = self.tags, self.entries
        for bucket in (first, second):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not tags[s]:
                    tags[s], entries[s] = tag, entry
                    return True
        moved, bucket = [], second
        for turn in range(self.kicks):
            s = bucket * SLOTS + (turn + tag) % SLOTS
            moved.append((s, tags[s], entries[s]))
            tag, tags[s], entry, entries[s] = tags[s], tag, entries[s], entry  # type: ignore[assignment]
            bucket ^= tag * 0x5BD1E995 & self.mask
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not tags[s]:
                    tags[s], entries[s] = tag, entry
                    return True
        for s, old_tag, old in reversed(moved):
            tags[s], entries[s] = old_tag, old
        return False

    def _grow(self, extra: list) -> None:
        held = [*self.values(), extra]
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._put(e) for e in held):
                return

    def delete(self, key: bytes) -> bool:
        """Removes a live key; false if there is none."""
        s = self._slot(key)
        if s < 0:
            return False
        self.tags[s], self.entries[s] = 0, None
        self.live -= 1
        return True

    def values(self) -> Iterator[list]:
        return (e for e in self.entries if e is not None)


@tidied
def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [hashlib.sha256((t or b"").lower()).digest() for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "digest"])


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest) for every row: SHA-256 of the whole text with A-Z lower-cased; null counts as empty."""
    ship(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_digest, "id long, digest binary")


def _batch(entries: list[list]) -> pa.RecordBatch:
    cols = list(zip(*entries, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["digest", "keep_id", "group_size"])


def _fold(limit: int | None):
    """Merges rows (digest, keep_id, group_size, drop) of a task; rows with drop delete the digest at the end."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, dropped = CuckooIndex(), []
        for batch in batches:
            for key, keep, size, drop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if drop:
                    dropped.append(key)
                elif (entry := index.get(key)) is None:
                    index.insert([key, keep, size])
                else:
                    entry[2] += size
                    if entry[1] is None or keep is not None and keep > entry[1]:
                        entry[1] = keep
            if limit and index.live >= limit:
                yield _batch(list(index.values()))
                index = CuckooIndex()
        for key in dropped:
            index.delete(key)
        held = list(index.values())
        for i in range(0, len(held), 50_000):
            yield _batch(held[i : i + 50_000])

    return run


_ENTRY = "digest binary, keep_id long, group_size long"


def update_index(index: DataFrame | None, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The index (digest, keep_id, group_size) after inserting the rows (id, digest) and then deleting digests.

    A deleted digest is no longer live, whatever its group's size; digests that are not live are ignored.
    Of equal digests the largest id is kept; null ids count in group_size and are kept only if there is no other.
    """
    parts, rows = [], 0
    drop = F.lit(False).alias("drop")
    if inserted is not None:
        own = inserted.select("digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), drop)
        parts.append(own.mapInArrow(_fold(FOLD), _ENTRY).withColumn("drop", drop))
        rows += inserted.count()
    if index is not None:
        parts.append(index.select("digest", "keep_id", "group_size", drop))
        rows += index.count()
    if deleted is not None:
        parts.append(deleted.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("drop")).distinct())
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    shards = max(shuffle_partitions(every.sparkSession), -(-rows // SHARD))
    return every.repartition(shards, "digest").mapInArrow(_fold(None), _ENTRY)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null and empty texts are equal. The largest id of a
    group is kept. Repeated rows count in group_size and share their result; a row with a null id is kept only in
    a group without any other id, where keep_id is null. Other columns are not read.
    """
    rows = stored(digests(docs, id_col, text_col), "digests")
    index = stored(update_index(None, rows), "cuckoo-index")
    both = rows.join(index, "digest")
    return both.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def normal_sha256(text: Column) -> Column:
    """SHA-256 of a text with A-Z lower-cased, in hexadecimal, as exact_duplicates() gives it."""
    return F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase).cast("binary"), 256)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of equal texts, with all its columns: the one with the largest id, null being the least.

    Rows are told apart by id and text, so a row with a null or repeated id and a text of its own stays. Of repeated
    rows (equal id and text) one stays, the least by its other columns (maps aside). Null and empty texts are equal.
    Rows of which no id is in a group of several stay where they lie; an empty table gives an empty one.
    """
    rows = stored(exact_duplicates(docs, id_col, text_col), "exact-duplicates").withColumnRenamed(id_col, "id").withColumnRenamed("text_sha256", "mark")
    several = stored(rows.where("group_size > 1").groupBy("id", "mark").agg(F.max("kept").alias("kept"), F.count("*").alias("copies")), "groups")
    mark = normal_sha256(F.col(text_col))
    touched = several.where("not kept or copies > 1")
    left = without_rows(docs, id_col, mark, touched)
    repeated = touched.where("kept")
    if repeated.isEmpty():
        return left
    names = [free_name(docs.columns, c) for c in ("_id", "_mark", "_own")]
    again = split(docs, id_col, repeated.select("id"))[1].withColumn(names[2], mark)
    there = F.col(id_col).cast("long").eqNullSafe(F.col(names[0])) & (F.col(names[2]) == F.col(names[1]))
    again = again.join(repeated.select("id", "mark").toDF(*names[:2]), there, "left_semi")
    order = F.struct(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind])
    one = again.groupBy(F.col(id_col).alias(names[0]), names[2]).agg(F.min_by(F.struct(*docs.columns), order).alias(names[1]))
    return left.union(one.select(f"{names[1]}.*"))


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
