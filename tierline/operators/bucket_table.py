"""Keyed tables of which a write touches only the buckets that hold its keys.

Rows are dealt to a fixed number of buckets by the hash of their key. A manifest names the folder
of each bucket, and a new manifest, written last and renamed into place, makes a write visible
as a whole: buckets that hold no key of the write keep their folders. Folders that no manifest
names (a write that failed, an old version) are invisible and removed by ``drop_old``. A table
has one writer at a time; of two that meet, the second one fails and can be repeated.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.functions.names import col
from tierline.functions.spread import materialize, scratch_folders
from tierline.operators.scd2 import scd2_changes
from tierline.operators.stage import latest_per_key, merge_upsert
from tierline.operators.tables import path_exists, read_text, write_text

BUCKETS = 64
_BUCKET = "_bucket"
_MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Manifest:
    """One version of a table: its key, columns, the folder of each filled bucket and folders that are only added to."""

    version: int
    key: list[str]
    buckets: int
    schema: dict
    folders: dict[int, str] = field(default_factory=dict)
    added: list[str] = field(default_factory=list)
    #: What else became true with this version, such as the version of another table that it was made from.
    note: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(**{**found, "folders": {int(k): v for k, v in found["folders"].items()}})


class BucketTable:
    """A table of unique keys (rows without a full key are kept side by side) with upserts by bucket.

    With ``upto`` it is the table at an older version, which can only be read.
    """

    def __init__(self, spark: SparkSession, root: str, *, buckets: int = BUCKETS, upto: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.upto = upto

    def _path(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def versions(self) -> list[int]:
        fs, folder = self._path(f"{self.root}/{_MANIFESTS}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        found = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
        return found if self.upto is None else [v for v in found if v <= self.upto]

    def _file(self, version: int) -> str:
        return f"{self.root}/{_MANIFESTS}/{version:08d}.json"

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version, the newest one unless stated; None before the first write."""
        found = self.versions()
        if not found:
            return None
        return Manifest.from_json(read_text(self.spark, self._file(version or found[-1])))

    def exists(self) -> bool:
        return bool(self.versions())

    def _require_newest(self) -> None:
        if self.upto is not None:
            raise RuntimeError(f"{self.root} is held at version {self.upto} by a batch that is not committed")

    def restore(self, version: int) -> None:
        """Takes back the versions after ``version``; their folders go with ``drop_old``."""
        for later in reversed([v for v in self.versions() if v > version]):
            fs, path = self._path(self._file(later))
            fs.delete(path, False)

    def _commit(self, new: Manifest) -> None:
        if path_exists(self.spark, self._file(new.version)):
            raise RuntimeError(f"{self.root}: version {new.version} was written by somebody else")
        write_text(self.spark, self._file(new.version), new.to_json())

    def _load(self, manifest: Manifest, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(manifest.schema)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame | None:
        manifest = self.manifest(version)
        return None if manifest is None else self._load(manifest, [*manifest.folders.values(), *manifest.added])

    def changes(self, since: int, until: int, sign: str) -> DataFrame:
        """Rows of the buckets that differ between two versions: those of ``since`` with -1 in ``sign``, those of ``until`` with 1.

        Version 0 is the empty table. Rows that did not change come with both signs and cancel out in sums; buckets that
        no write between the versions touched are not read.
        """
        new = self.manifest(until)
        old = self.manifest(since) if since else Manifest(0, new.key, new.buckets, new.schema)
        now, then = {*new.folders.values(), *new.added}, {*old.folders.values(), *old.added}
        gone = self._load(old, sorted(then - now)).withColumn(sign, F.lit(-1))
        return gone.unionByName(self._load(new, sorted(now - then)).withColumn(sign, F.lit(1)))

    def _bucket(self, key: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in key]), F.lit(buckets)).cast("int")

    def _write_buckets(self, rows: DataFrame, key: list[str], buckets: int) -> tuple[str, list[int]]:
        """Writes rows by bucket, one file each, below a folder of their own."""
        folder = f"data/{uuid.uuid4().hex}"
        placed = rows.withColumn(_BUCKET, self._bucket(key, buckets)).repartition(F.col(_BUCKET))
        placed.write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        fs, path = self._path(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return folder, [int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}=")]

    def upsert(self, source: DataFrame, key: list[str], *, order: list[Column] | None = None) -> DataFrame:
        """Rows of ``source`` replace those of equal key; ``order`` sorts best-first where a key comes twice."""
        before = self.manifest()
        with scratch_folders(self.spark):
            incoming = latest_per_key(source, key, order) if order else source
            self.upsert_from(before, incoming, key, [])
        return self.read()

    def upsert_from(self, before: Manifest | None, incoming: DataFrame, key: list[str], added: list[str], note: dict | None = None) -> None:
        """The upsert on top of a version that was read; it fails if another write came since. ``added`` are folders to be named as they are."""
        self._require_newest()
        if before is None:
            manifest = Manifest(1, list(key), self.buckets, json.loads(incoming.schema.json()), note=note or {})
            folder, filled = self._write_buckets(incoming, key, self.buckets)
            self._commit(Manifest(**{**manifest.__dict__, "folders": {b: f"{folder}/{_BUCKET}={b}" for b in filled}, "added": added}))
            return
        if list(key) != before.key:
            raise ValueError(f"the table is keyed by {before.key}, not by {key}")
        schema = StructType.fromJson(before.schema)
        # The types of the table: the hash of a key depends on them.
        incoming = materialize(incoming.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), "incoming")
        touched = sorted(r[0] for r in incoming.select(self._bucket(key, before.buckets)).distinct().collect())
        if not touched:
            if note is not None:
                self._commit(Manifest(**{**before.__dict__, "version": before.version + 1, "note": note}))
            return
        old = [before.folders[b] for b in touched if b in before.folders]
        merged = merge_upsert(self._load(before, old), incoming, key)
        folder, filled = self._write_buckets(merged, key, before.buckets)
        folders = {**before.folders, **{b: f"{folder}/{_BUCKET}={b}" for b in filled}}
        self._commit(Manifest(before.version + 1, before.key, before.buckets, before.schema, folders, [*before.added, *added], before.note if note is None else note))

    def drop_old(self, keep: int = 2) -> None:
        """Removes all but the newest ``keep`` versions and the folders that none of them names."""
        self._require_newest()
        found = self.versions()
        kept = [self.manifest(v) for v in found[-keep:]]
        named = {f for m in kept for f in [*m.folders.values(), *m.added]}
        for version in found[:-keep]:
            fs, path = self._path(self._file(version))
            fs.delete(path, False)
        for kind in ("data", "closed"):
            fs, path = self._path(f"{self.root}/{kind}")
            for batch in fs.listStatus(path) if fs.exists(path) else []:
                whole = f"{kind}/{batch.getPath().getName()}"
                inner = [s.getPath() for s in fs.listStatus(batch.getPath()) if s.getPath().getName().startswith(f"{_BUCKET}=")]
                used = [p for p in inner if f"{whole}/{p.getName()}" in named]
                if whole not in named and not used:
                    fs.delete(batch.getPath(), True)
                for p in inner if used else []:
                    if p not in used:
                        fs.delete(p, True)


class Scd2Table(BucketTable):
    """A history with its active versions in buckets and its closed ones in folders that are only added to.

    A run joins the snapshot with the active versions, writes the changes once, and from them the
    touched buckets and one folder of closed versions; without changes it writes nothing. The history
    before a run is never read or rewritten. Keys never lose their active version, so the
    next number of a version is that of the active one and one.
    """

    def active(self) -> DataFrame | None:
        manifest = self.manifest()
        return None if manifest is None else self._load(manifest, list(manifest.folders.values()))

    def merge(self, snapshot: DataFrame, key: list[str], tracked: list[str], now: str) -> DataFrame:
        """Adds the versions of one run and returns the whole history."""
        before = self.manifest()
        with scratch_folders(self.spark):
            if before is None:
                self.upsert_from(None, scd2_changes(None, snapshot, key, tracked, now), key, [])
                return self.read()
            changes = materialize(scd2_changes(self.active(), snapshot, key, tracked, now), "changes")
            closed = changes.filter(~F.col("active_flag"))
            added: list[str] = []
            if not closed.isEmpty():
                added = [f"closed/{uuid.uuid4().hex}"]
                schema = StructType.fromJson(before.schema)
                closed.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(f"{self.root}/{added[0]}")
            self.upsert_from(before, changes.filter("active_flag"), key, added)
        return self.read()
