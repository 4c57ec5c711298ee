"""Sharding with size-tiered compaction and a versioned manifest.

Arrivals are appended as small immutable Parquet shards. Shards of similar size (the same tier) are merged, once
there are enough of them, into files of a target size. Every change is a new manifest version, written aside and
published whole in one step that fails where the version is there already: a reader sees the shards of one version,
and of two writers one starts over from the other's.

That step is a hard link on local disks and a rename elsewhere, which HDFS refuses onto an existing file. Object stores
replace on rename; their manifests are created without overwriting, which is safe where the store's connector makes
that a conditional put, and with a single writer otherwise.
"""

from __future__ import annotations

import functools
import json
import math
import time
import uuid
from collections.abc import Set
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.llm.runtime import free_name

#: Schemes of file systems that refuse to rename onto an existing file.
REFUSING = ("hdfs", "viewfs", "webhdfs", "ofs")

#: Shards whose names go to every task at once, about 150 bytes each; more are read in parts.
LISTED = 50_000


@dataclass(frozen=True)
class Settings:
    """target: bytes of a file. fan: shards of a tier that are merged at once, and the ratio between tiers.

    A shard of half the target or more is full and stays. batch: files merged in one job and commit.
    """

    target: int = 128 << 20
    fan: int = 4
    batch: int = 1000


@dataclass
class Manifest:
    """A version and its shards: name, bytes, rows, sequence of arrival."""

    version: int = 0
    shards: list[dict] = field(default_factory=list)
    arrivals: int = 0


class ShardStore:
    """A folder of shards and manifests in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings | None = None) -> None:
        self.spark, self.path, self.s = spark, path.rstrip("/"), settings or Settings()
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or one by its version; version 0 is empty."""
        folder = self._at("manifests")
        if version is None:
            names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
            version = max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)
        if not version:
            return Manifest()
        stream = self._fs.open(self._at(f"manifests/v{version:08d}.json"))
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _put(self, path, text: str) -> None:
        out = self._fs.create(path, False)
        out.write(text.encode())
        out.close()

    def commit(self, new: Manifest) -> bool:
        """Publishes a manifest as the version after the one it was made from; false if another came first."""
        text, final = json.dumps(new.__dict__), self._at(f"manifests/v{new.version:08d}.json")
        scheme = self._fs.getUri().getScheme()
        if scheme != "file" and scheme not in REFUSING:
            try:
                self._put(final, text)
            except Py4JJavaError as e:
                if not self._fs.exists(final):
                    raise e
                return False
            return True
        aside = self._at(f"manifests/.{uuid.uuid4().hex}")
        self._put(aside, text)
        try:
            if scheme != "file":
                return bool(self._fs.rename(aside, final))
            local = lambda p: self._jvm.java.io.File(p.toUri().getPath()).toPath()
            self._jvm.java.nio.file.Files.createLink(local(final), local(aside))
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            self._fs.delete(aside, False)

    def _files(self, run: str) -> dict[str, int]:
        """The data files below a folder, with bytes."""
        found, entries = {}, self._fs.listFiles(self._at(run), True)
        while entries.hasNext():
            f = entries.next()
            name = f.getPath().toUri().getPath()
            if f.getPath().getName().startswith("part-"):
                found[name[name.rindex(f"/{run}/") + 1 :]] = f.getLen()
        return found

    def name_of(self, rows: DataFrame):
        """The shard that a row lies in, as the manifest names it."""
        return F.regexp_extract(rows.metadataColumn("_metadata")["file_path"], "/(data/[0-9a-f]{32}/.*)$", 1)

    def _write(self, rows: DataFrame, by: str | None = None) -> list[dict]:
        """Writes a run's files (apart by a column, which they don't hold) and lists them with bytes and rows."""
        run = f"data/{uuid.uuid4().hex}"
        out = rows.write.partitionBy(by) if by else rows.write
        out.parquet(f"{self.path}/{run}")
        files = self._files(run)
        if not files:
            return []
        back = self.spark.read.schema(rows.drop(by).schema if by else rows.schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{run}")
        count = {r["name"]: r["count"] for r in back.select(self.name_of(back).alias("name")).groupBy("name").count().collect()}  # a row per file
        return [{"name": n, "bytes": size, "rows": count[n]} for n, size in sorted(files.items()) if count.get(n)]

    def _publish(self, shards: list[dict]) -> Manifest:
        while True:
            base = self.manifest()
            new = Manifest(base.version + 1, [*base.shards, *({**x, "arrival": base.arrivals} for x in shards)], base.arrivals + 1)
            if self.commit(new):
                return new

    def append(self, rows: DataFrame) -> Manifest:
        """Adds an arrival as shards of its own; the files come as its partitions do."""
        return self._publish(self._write(rows))

    def staged(self, rows: DataFrame, by: str, values: list) -> list[list[dict]]:
        """The shards of several arrivals, told apart by a column and written in one pass; see append_staged()."""
        shards = self._write(rows, by)
        return [[x for x in shards if f"/{by}={v}/" in x["name"]] for v in values]

    def append_staged(self, shards: list[dict]) -> Manifest:
        return self._publish(shards)

    def tier(self, size: int) -> int:
        """0 for full files, of half the target and above, and one more for each factor of the fan below that."""
        return max(0, math.ceil(math.log(self.s.target / 2 / max(1, size), self.s.fan) - 1e-9))

    def due(self, m: Manifest) -> list[list[dict]]:
        """Groups of shards to merge into a file each, of the smallest files' tier that has enough; none if none has.

        The tier's shards come in order of arrival; a group is closed once it reaches the target, so its bytes are
        between one and one and a half times that, and the rest is a group if it has `fan` shards. Every group has two
        shards or more: each merge leaves fewer files, so compaction ends.
        """
        tiers: dict[int, list[dict]] = {}
        for x in m.shards:
            tiers.setdefault(self.tier(x["bytes"]), []).append(x)
        for t in sorted(tiers, reverse=True):
            if t and len(tiers[t]) >= self.s.fan:
                groups: list[list[dict]] = [[]]
                for x in sorted(tiers[t], key=lambda x: (x["arrival"], x["name"])):
                    groups[-1].append(x)
                    if sum(y["bytes"] for y in groups[-1]) >= self.s.target:
                        groups.append([])
                if len(groups[-1]) < self.s.fan:
                    groups.pop()
                return groups[: self.s.batch]
        return []

    def compact(self, schema, spared: Set[str] | None = None) -> Manifest:
        """Merges tiers until none is due: a task a file, and nothing is shuffled.

        Shards that merged ones replace stay on disk until vacuum(). A folder's only writer may name the shards that
        it has not committed yet; then each merge deletes what it replaced, and no more than a batch lies there twice.
        """
        while True:
            base = self.manifest()
            groups = self.due(base)
            if not groups:
                return base
            files = [self.spark.read.schema(schema).parquet(*[f"{self.path}/{x['name']}" for x in g]).coalesce(1) for g in groups]
            merged = self._write(functools.reduce(DataFrame.unionAll, files))
            first = [min(x["arrival"] for x in g) for g in groups]
            for x in merged:
                x["arrival"] = min(first)
            gone = {x["name"] for g in groups for x in g}
            done = self.commit(Manifest(base.version + 1, [x for x in base.shards if x["name"] not in gone] + merged, base.arrivals))
            if not done:  # what another writer left of these shards is merged in the next turn
                for x in merged:
                    self._fs.delete(self._at(x["name"]), False)
            elif spared is not None:
                self.vacuum(0, spared)

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default, from its shards alone."""
        shards = self.manifest(version).shards
        if not shards:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{x['name']}" for x in shards])

    def vacuum(self, age: float = 86400.0, spared: Set[str] = frozenset()) -> int:
        """Deletes shards that the newest manifest does not list and that are older than `age` seconds.

        Younger ones may be another writer's, written and not committed yet; so may those that are spared by name.
        Older versions can't be read after it.
        """
        live, gone, now = {x["name"] for x in self.manifest().shards} | spared, 0, time.time()
        entries = self._fs.listFiles(self._at("data"), True)
        while entries.hasNext():
            f = entries.next()
            name = f.getPath().toUri().getPath()
            name = name[name.rindex("/data/") + 1 :]
            if f.getPath().getName().startswith("part-") and name not in live and f.getModificationTime() / 1000 <= now - age:
                self._fs.delete(f.getPath(), False)
                gone += 1
        return gone


def sharded(docs: DataFrame, path: str, arrivals: int = 8, id_col: str = "doc_id", settings: Settings | None = None) -> DataFrame:
    """The documents, read back through the last manifest after they arrived in batches: all columns and shard.

    A document belongs to the arrival that its id's crc32 names; null ids are an arrival's like others. The documents
    are read once and written as the arrivals' shards; arrivals are appended one after the other, and after each one
    due tiers are compacted and replaced shards deleted (the folder is this call's own). shard is the place of the
    row's file in the manifest, shard_rows and shard_bytes are the file's. Repeated rows and null or very long texts
    stay as they are; an empty table gives an empty result. A column of the documents with one of these names is kept
    under its own name, and the new one gets a `_`.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, path, settings)
    by = free_name(docs.columns, "lot")
    lot = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % arrivals, F.lit(0))
    waiting = store.staged(docs.withColumn(by, lot), by, list(range(arrivals)))
    while waiting:
        store.append_staged(waiting.pop(0))
        store.compact(docs.schema, {x["name"] for shards in waiting for x in shards})
    last = store.manifest()
    new = {c: free_name(docs.columns, c) for c in ("shard", "shard_rows", "shard_bytes")}
    kinds = [f"{c} {t}" for c, t in zip(new.values(), ("int", "long", "long"), strict=True)]
    if not last.shards:
        return docs.limit(0).select("*", *[F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in kinds])
    key = free_name([*docs.columns, *new.values()], "shard_name")

    def labelled(first: int) -> DataFrame:
        some = last.shards[first : first + LISTED]
        listed = spark.createDataFrame([(x["name"], k, x["rows"], x["bytes"]) for k, x in enumerate(some, first)], ", ".join([f"`{key}` string", *kinds]))
        rows = spark.read.schema(docs.schema).parquet(*[f"{store.path}/{x['name']}" for x in some])
        return rows.withColumn(key, store.name_of(rows)).join(F.broadcast(listed), key).select(*docs.columns, *new.values())

    return functools.reduce(DataFrame.unionAll, [labelled(k) for k in range(0, len(last.shards), LISTED)])
