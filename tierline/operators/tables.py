"""Parquet tables that are replaced as a whole without ever overwriting what is being read."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_PREFIX = "snapshot="
_SCHEMA = "schema.json"
# Which batch appended a row; kept as a partition so that a repeated batch replaces
# its own rows. Not part of the table's data.
LOAD_BATCH = "_load_batch"


class SnapshotTable:
    """A folder of numbered snapshots; the newest finished one is the table.

    A snapshot counts once Spark has written its ``_SUCCESS`` marker, so readers see
    the old or the new state and a failed write leaves the table as it was.

    With ``upto`` it is the table at an older version, without the appends of the
    batches in ``without``; it can then only be read.
    """

    def __init__(self, spark: SparkSession, root: str, *, upto: int | None = None, without: frozenset[str] = frozenset()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.upto = upto
        self.without = without

    def _require_newest(self) -> None:
        if self.upto is not None:
            raise RuntimeError(f"{self.root} is held at version {self.upto} by batches that are not committed: {sorted(self.without)}")

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def versions(self) -> list[int]:
        """Finished snapshots, oldest first."""
        fs, root = self._fs(self.root)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        found = sorted(int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX))
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path
        found = found if self.upto is None else [v for v in found if v <= self.upto]
        return [v for v in found if fs.exists(jvm_path(f"{self._folder(v)}/_SUCCESS"))]

    def _folder(self, version: int) -> str:
        return f"{self.root}/{_PREFIX}{version:08d}"

    def current(self) -> str | None:
        found = self.versions()
        return self._folder(found[-1]) if found else None

    def exists(self) -> bool:
        return self.current() is not None

    def _load(self, folder: str) -> DataFrame:
        fs, path = self._fs(f"{self.root}/{_SCHEMA}")
        reader = self.spark.read
        if not self._has_rows(folder) and fs.exists(path):
            # Partitioned writes of no rows leave no file to take the schema from.
            text = self.spark.read.text(f"{self.root}/{_SCHEMA}", wholetext=True).first().value
            reader = reader.schema(StructType.fromJson(json.loads(text)))
        loads = partition_folders(self.spark, folder, LOAD_BATCH) if self.without else {}
        if self.without & loads.keys():
            kept = [path for batch, path in loads.items() if batch not in self.without]
            whole = self.spark.read.option("mergeSchema", False).parquet(folder).drop(LOAD_BATCH)
            return reader.schema(whole.schema).parquet(*kept) if kept else whole.limit(0)
        return reader.option("mergeSchema", False).parquet(folder).drop(LOAD_BATCH)

    def _has_rows(self, folder: str) -> bool:
        """Whether a snapshot has any data file or partition."""
        fs, path = self._fs(folder)
        return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(path))

    def partition_columns(self, folder: str) -> list[str]:
        """The columns a snapshot is partitioned by, from the names of its folders."""
        names: list[str] = []
        while True:
            fs, path = self._fs("/".join([folder, *names]))
            inner = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()]
            if not inner:
                return [n.split("=", 1)[0] for n in names]
            names.append(inner[0])

    def read(self) -> DataFrame | None:
        """The current state, or None before the first write."""
        folder = self.current()
        return None if folder is None else self._load(folder)

    def replace(self, df: DataFrame) -> DataFrame:
        """Writes the next snapshot, partitioned like the one before, and returns it."""
        self._require_newest()
        found = self.versions()
        folder = self._folder((found[-1] if found else 0) + 1)
        parts = self.partition_columns(self._folder(found[-1])) if found else []
        own = [p for p in parts if p != LOAD_BATCH]
        self._create(df, folder, "merged" if LOAD_BATCH in parts else None, own)
        return self._load(folder)

    def _create(self, df: DataFrame, folder: str, batch_id: str | None, partition_by: list[str] | None = None) -> None:
        parts = list(partition_by or [])
        fs, path = self._fs(f"{self.root}/{_SCHEMA}")
        out = fs.create(path, True)
        out.write(bytearray(df.schema.json(), "utf-8"))
        out.close()
        if batch_id is not None:
            df, parts = df.withColumn(LOAD_BATCH, F.lit(batch_id)), [LOAD_BATCH, *parts]
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).parquet(folder)

    def append(self, df: DataFrame, *, batch_id: str | None = None) -> None:
        """Adds rows to the current snapshot, creating the first one if needed.

        With a ``batch_id`` the rows form a partition of their own and appending the
        same batch again replaces it; use it for all appends to a table or for none.
        """
        self._require_newest()
        folder = self.current()
        if folder is None:
            self._create(df, self._folder(1), batch_id)
        elif batch_id is None:
            df.write.mode("append").parquet(folder)
        else:
            replace_batch(df, folder, LOAD_BATCH, batch_id)

    def create_partitioned(self, df: DataFrame, partition_by: list[str]) -> None:
        """Writes the first snapshot with partitions that later merges rewrite one by one."""
        self._require_newest()
        self._create(df, self._folder(1), None, partition_by)

    def drop_old(self, keep: int = 2) -> None:
        """Removes all but the newest ``keep`` snapshots."""
        self._require_newest()
        for version in self.versions()[:-keep]:
            fs, path = self._fs(self._folder(version))
            fs.delete(path, True)

    def restore(self, version: int, batch_id: str) -> None:
        """Takes back what a batch wrote since ``version``: later snapshots, finished or not, and its own appends."""
        fs, root = self._fs(self.root)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        numbers = sorted((int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX)), reverse=True)
        for later in [n for n in numbers if n > version]:
            fs.delete(self._fs(self._folder(later))[1], True)
        if version in numbers:
            remove_partition(self.spark, self._folder(version), LOAD_BATCH, batch_id)


def replace_batch(df: DataFrame, path: str, batch_column: str, batch_id: str, **parts: str) -> None:
    """Writes one batch as its own partition; running the same batch again replaces it.

    ``parts`` adds further partition columns, for tables a batch writes to more than once.
    """
    fixed = {batch_column: batch_id, **parts}
    (
        df.withColumns({name: F.lit(value) for name, value in fixed.items()})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*fixed)
        .parquet(path)
    )


def partition_folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """The folders of a table's first partition column by value; Spark's escapes in names are undone."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
    return {unquote(n.split("=", 1)[1]): f"{path}/{n}" for n in names if n.startswith(column + "=")}


def remove_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    folder = partition_folders(spark, path, column).get(value)
    if folder is not None:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def read_batches(spark: SparkSession, path: str, column: str, without: frozenset[str]) -> DataFrame | None:
    """A table partitioned by batch without some batches; None where no other batch has written to it.

    The batch comes back as text, whatever its id looks like.
    """
    kept = {batch: folder for batch, folder in partition_folders(spark, path, column).items() if batch not in without}
    if not kept:
        return None
    rows = spark.read.option("mergeSchema", False).parquet(*kept.values())
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{column}=([^/]*)/", 1)
    # File names are URIs: the escapes of the folder's name are escaped once more.
    return rows.withColumn(column, F.url_decode(F.url_decode(F.replace(name, F.lit("+"), F.lit("%252B")))))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file beside a table, such as a schema or a manifest; None where there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file under a passing name and renames it, so that no reader sees a part of it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    ready, draft = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    fs = ready.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(ready):
        fs.delete(ready, False)
    if not fs.rename(draft, ready):
        raise RuntimeError(f"{path} was written by somebody else")


class LogTable:
    """An append log partitioned by batch and part, whose schema is kept beside it.

    So a log without rows is read as one without rows, batch ids stay texts whatever they look
    like, and columns that a later write adds are NULL in earlier rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, batch_id: str, part: str) -> None:
        """Adds the rows of one part of a batch; the same part again replaces them."""
        fields = {f.name: f for f in self._known()}
        new = [f for f in df.schema.fields if f.name not in fields and f.name not in ("batch_id", "part")]
        if new or not fields:
            schema = StructType([*fields.values(), *[StructField(f.name, f.dataType) for f in new]])
            write_text(self.spark, f"{self.path}/_{_SCHEMA}", schema.json())
        replace_batch(df, self.path, "batch_id", batch_id, part=part)

    def _known(self) -> list[StructField]:
        text = read_text(self.spark, f"{self.path}/_{_SCHEMA}")
        return [] if text is None else StructType.fromJson(json.loads(text)).fields

    def read(self, without: frozenset[str] = frozenset()) -> DataFrame | None:
        """The rows of all batches but some, with their ``batch_id``; None before the first write."""
        if not path_exists(self.spark, self.path):
            return None
        known = self._known()
        if known:
            ids = [StructField(name, StringType()) for name in ("batch_id", "part")]
            rows = self.spark.read.schema(StructType([*known, *ids])).parquet(self.path).drop("part")
        else:
            rows = self.spark.read.parquet(self.path).drop("part")
        return rows.filter(~F.col("batch_id").isin(sorted(without))) if without else rows

    def remove(self, batch_id: str) -> None:
        """Removes the rows of a batch."""
        remove_partition(self.spark, self.path, "batch_id", batch_id)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))
