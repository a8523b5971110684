"""The batch pipeline: gate, bronze, checks, silver, profile, gold, over many files at once."""

from __future__ import annotations

import copy
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import FILE_CHECKSUM, FILE_NAME, FILE_PATH, METADATA, col, data_columns
from tierline.functions.spread import attach_by_key, is_small, materialize, scratch_folders, top_per_key
from tierline.operators import alerts as alert_ops
from tierline.operators.anomaly import RUN_NUMBER, anomaly_messages, anomaly_reasons, score_history
from tierline.operators.bronze import checksum_dedup, file_checksums, land_bronze, landed_checksums, read_batch
from tierline.operators.bucket_table import BUCKETS, BucketTable, Scd2Table
from tierline.operators.commits import FAILED as FAILED_BATCH
from tierline.operators.commits import UNDONE, BatchJournal
from tierline.operators.checks import FAILED, Rule, check_rows, distinct_reasons, split_batch
from tierline.operators.gates import Bounds, control_gates, line_counts
from tierline.operators.lineage import raw_to_stage_edges
from tierline.operators.monitor import batch_outcomes, layers_to_run
from tierline.operators.profile import compute_profile
from tierline.operators.quarantine import quarantine_files, quarantine_rows
from tierline.operators.rows import with_row_index
from tierline.operators.stage import latest_per_key, upsert_partitions, write_stage
from tierline.operators.tables import LogTable, SnapshotTable, partition_folders, read_batches
from tierline.plans.gold import GoldBuild, run_gold_build
from tierline.sources.files import file_sort_key, list_files, require_matches, select_files
from tierline.sources.registry import read_records

_ANY: Bounds = (0, 2**62)
# What the log of landed files keeps of a file.
_LANDED = (FILE_PATH, FILE_NAME, FILE_CHECKSUM, "length", "sort_key", "run_id")
_LAYERS = ("raw", "stage", "gold")
# Logs that show what a failed batch did, and those that must not hold anything of it.
_TELL_OF_FAILURES = ("step_events", "lineage_events", "alerts")
_TAKEN_BACK = ("runs", "quarantine", "run_reasons", "profile_history", "lineage_edges")


@dataclass(frozen=True)
class AnomalyPolicy:
    metrics: tuple[str, ...]
    method: str = "zscore"
    threshold: float = 3.0
    window: int = 20
    on_anomaly: str = "alert"


@dataclass(frozen=True)
class Feed:
    """Everything that differs between two feeds; the pipeline itself never changes."""

    name: str
    fmt: str
    file_pattern: str
    rules: tuple[Rule, ...]
    business_key: tuple[str, ...]
    reader: Mapping[str, object] = field(default_factory=dict)
    order_by: str = "arrival_time"
    ts_format: str | None = None
    selection: str = "all"
    file_size: Bounds = _ANY
    row_count: Bounds = _ANY
    integrity_mode: str = "row_level"
    group_by: tuple[str, ...] = ()
    write_mode: str = "append"
    # Upserts then rewrite only the touched partitions of the silver table.
    partition_by: tuple[str, ...] = ()
    # Upserts then rewrite only the touched ones of so many hash buckets of the silver table.
    buckets: int = 0
    metadata: tuple[str, ...] = METADATA
    # Only has an effect with the checksum among the metadata.
    skip_known_content: bool = True
    anomaly: AnomalyPolicy | None = None
    gold: tuple[GoldBuild, ...] = ()
    stop_after: str = "stage"
    # Files behind one that cannot be read: they run ("continue") or wait for the next batch ("stop").
    on_earlier_failure: str = "continue"

    def __post_init__(self) -> None:
        if self.skip_known_content and FILE_CHECKSUM not in self.metadata:
            object.__setattr__(self, "skip_known_content", False)
        layers_to_run(self.stop_after)
        if self.on_earlier_failure not in ("continue", "stop"):
            raise ValueError(f"{self.name}: unknown policy {self.on_earlier_failure!r}")
        if self.buckets and (self.write_mode != "upsert" or self.partition_by):
            raise ValueError(f"{self.name}: buckets are for upserts, and instead of partitions")
        if self.write_mode == "upsert" and not self.business_key:
            raise ValueError(f"{self.name}: upsert needs a business key")


class Warehouse:
    """Where the tables of all feeds live, as folders below one root.

    Rows of batches that are not committed are not seen, and silver tables and marts that such a batch writes to
    are read as they were before it (see ``operators/commits.py``). Silver tables with ``partition_by`` are the exception:
    their partitions are replaced in place. Whoever reads several tables while a batch commits may see some before and some after it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.journal = BatchJournal(spark, f"{self.root}/control/_batches")
        self._sees_all = False

    def writing(self) -> Warehouse:
        """The same warehouse as batches see it themselves: with all that is not committed."""
        inner = copy.copy(self)
        inner._sees_all = True
        return inner

    def bronze(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}"

    def landed(self, feed: str) -> DataFrame | None:
        """The bronze rows of a feed; None before the first batch."""
        return read_batches(self.spark, self.bronze(feed), "batch_id", self._hidden())

    def rejected_files(self) -> DataFrame | None:
        """Files that a gate stopped, with their bytes; None where there are none. Large ones are kept as chunks beside them."""
        return read_batches(self.spark, self.folder("quarantined_files") + "/files", "batch_id", self._hidden())

    def _hidden(self, *, but_failed: bool = False) -> frozenset[str]:
        return frozenset() if self._sees_all else self.journal.hidden(but_failed=but_failed)

    def _kinds(self, place: str, keyed: type[BucketTable], **options: int) -> tuple[SnapshotTable, BucketTable]:
        """A table as snapshots and by buckets, each held where an open batch writes to it."""
        held = [] if self._sees_all else self.journal.held_at(place)
        root, ids = f"{self.root}/{place}", frozenset(h.batch_id for h in held)
        plain = SnapshotTable(self.spark, root, upto=min((h.snapshot for h in held), default=None), without=ids)
        return plain, keyed(self.spark, root, upto=min((h.manifest for h in held), default=None), **options)

    def stage(self, feed: str, buckets: int = 0) -> SnapshotTable | BucketTable:
        """The silver table of a feed; in ``buckets`` if it has been written so or is to be."""
        plain, dealt = self._kinds(f"silver/{feed}", BucketTable, buckets=buckets or BUCKETS)
        return dealt if dealt.exists() or (buckets and not plain.exists()) else plain

    def gold(self, name: str, materialized: str = "table") -> SnapshotTable | Scd2Table:
        """A mart; a history that was not begun as snapshots takes only its changes."""
        plain, history = self._kinds(f"gold/{name}", Scd2Table)
        return history if history.exists() or (materialized == "scd2" and not plain.exists()) else plain

    def resolved(self) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/control/quarantine_resolved")

    def folder(self, name: str) -> str:
        return f"{self.root}/control/{name}"

    def log(self, df: DataFrame, name: str, batch_id: str, part: str) -> None:
        """Adds rows of a batch to a control table; the same part again replaces them."""
        LogTable(self.spark, self.folder(name)).write(df, batch_id, part)

    def control(self, name: str) -> DataFrame | None:
        return LogTable(self.spark, self.folder(name)).read(self._hidden(but_failed=name in _TELL_OF_FAILURES))

    def begin(self, batch_id: str, feed: str, places: list[str]) -> None:
        """Marks a batch that is going to write to the tables in ``places``."""
        versions = {}
        for place in places:
            plain, keyed = self.writing()._kinds(place, BucketTable)
            versions[place] = tuple(max(t.versions(), default=0) for t in (plain, keyed))
        self.journal.begin(batch_id, feed, versions)

    def undo(self, batch_id: str, state: str = UNDONE) -> None:
        """Takes back what an open batch wrote; only what it landed stays, so that it can be finished."""
        for held in self.journal.held(batch_id):
            plain, keyed = self.writing()._kinds(held.place, BucketTable)
            plain.restore(held.snapshot, batch_id)
            keyed.restore(held.manifest)
        for name in _TAKEN_BACK:
            LogTable(self.spark, self.folder(name)).remove(batch_id)
        self.journal.close(batch_id, state)

    def recover(self) -> list[str]:
        """Takes back all open batches, for when none is running; returns their ids."""
        found = self.journal.open_batches()
        for batch_id in found:
            self.undo(batch_id)
        return found


@dataclass(frozen=True)
class BatchResult:
    """What a batch did. ``runs`` has one row per file: status, layer reached, counts, reasons."""

    batch_id: str
    runs: DataFrame


def _structs(rows: list[tuple], names: tuple[str, ...]) -> Column:
    made = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, row)]) for row in rows])
    return made.cast("array<struct<" + ",".join(f"`{n}`:string" for n in names) + ">>")


class _Steps:
    """Step and lineage events of all files of a batch."""

    def __init__(self, house: Warehouse, feed: Feed, batch_id: str, files: DataFrame, at: Column, part: str = ""):
        self.house, self.feed, self.batch_id, self.at = house, feed, batch_id, at
        # A resumed batch writes parts of its own, behind what it wrote before.
        self.part = part and part + "-"
        self.order = 1000 if part else 0
        self.current, self.running = "control_gate", files
        self.lineage_rows: list[DataFrame] = []

    def event(self, files: DataFrame, step: str, target: str, status: Column, rows_in: Column, rows_out: Column) -> DataFrame:
        # Events of one batch share the batch time; the order within it is kept in microseconds.
        self.order += 1
        at = F.timestamp_micros(F.unix_micros(self.at) + F.lit(self.order))
        return files.select(
            F.col("run_id").alias("process_id"), F.lit(self.feed.name).alias("pipeline_name"), F.lit(step).alias("step"),
            F.lit(target).alias("target_table"), rows_in.cast("long").alias("row_count_in"),
            rows_out.cast("long").alias("row_count_out"), status.alias("status"), at.alias("event_at"),
        )

    def begin(self, files: DataFrame, step: str, target: str) -> DataFrame:
        none = F.lit(None)
        return self.event(files, step, target, F.lit("begin"), none, none)

    def write(self, part: str, *events: DataFrame) -> None:
        self.house.log(reduce(DataFrame.unionByName, events), "step_events", self.batch_id, self.part + part)

    def lineage(
        self, files: DataFrame, step: str, state: Column, source: Column, target: str, *,
        fields: list[tuple[str, str, str]] = (), columns: list[tuple[str, str, str, str, str]] = (),
    ) -> None:
        """START of a step and how it ended, with the columns of its tables and where they come from, where they are given."""
        ended = F.explode(F.array(F.lit("START"), state)).alias("event_type")
        self.lineage_rows.append(
            files.select(
                ended, self.at.alias("event_time"), "run_id", F.lit(f"{self.feed.name}.{step}").alias("job"),
                F.array(source).alias("inputs"), F.array(F.lit(target)).alias("outputs"),
                _structs(fields, ("dataset", "column", "type")).alias("schema_fields"),
                _structs(columns, ("output", "output_column", "input", "input_column", "description")).alias("column_lineage"),
            )
        )

    def write_lineage(self) -> None:
        if self.lineage_rows:
            self.house.log(reduce(DataFrame.unionByName, self.lineage_rows), "lineage_events", self.batch_id, self.part + "all")

    def alert(self, messages: DataFrame, part: str) -> None:
        self.house.log(
            messages.select(F.lit(self.feed.name).alias("pipeline_name"), self.at.alias("alerted_at"), "file_name", "row_index", "message"),
            "alerts", self.batch_id, part,
        )

    @contextmanager
    def recorded(self) -> Iterator[None]:
        """An exception inside leaves a failed step and lineage event behind."""
        try:
            yield
        except Exception:
            none = F.lit(None)
            self.write("failed", self.event(self.running, self.current, "", F.lit("failed"), none, none))
            layer = {"raw": "bronze", "stage": "silver", "gold": "gold"}.get(self.current, "bronze")
            self.lineage(self.running, self.current, F.lit("FAIL"), F.col(FILE_PATH), f"{layer}.{self.feed.name}")
            self.write_lineage()
            raise


def discover(spark: SparkSession, feed: Feed, path: str | list[str], *, strict: bool = True) -> DataFrame:
    """The files of a feed, selected and in order."""
    listing = list_files(spark, path)
    require_matches(listing, feed.file_pattern)
    manifest = file_sort_key(
        listing, feed.file_pattern, order_by=feed.order_by, ts_format=feed.ts_format, strict=strict
    )
    return select_files(manifest, feed.selection)


def _with_order(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    narrow = manifest.select(FILE_PATH, "sort_key", "length")
    if is_small(narrow):
        return rows.join(F.broadcast(narrow.drop("length")), FILE_PATH, "left")
    return attach_by_key(rows, narrow, [FILE_PATH], ["sort_key"], rows="length", hot_rows=1024**3)


def _write_stage(feed: Feed, valid: DataFrame, manifest: DataFrame, table: SnapshotTable | BucketTable, batch_id: str) -> None:
    """``manifest`` holds the promoted files."""
    names = [col(c) for c in data_columns(valid.columns)]
    if feed.write_mode == "append":
        write_stage(valid.select(*names), table, "append", batch_id=batch_id)
        return
    if feed.write_mode == "truncate_load":
        # Each file replaces the table, so the last promoted one is what remains.
        # It may have no valid row, then none remains.
        last = manifest.orderBy(F.desc("sort_key"), F.desc(FILE_PATH)).limit(1)
        # One row: the path of that file.
        kept = valid.join(F.broadcast(last.select(FILE_PATH)), FILE_PATH, "left_semi")
        write_stage(kept.select(*names), table, "truncate_load")
        return
    # The latest file wins where several carry a key.
    placed = _with_order(valid, manifest)
    order = [F.desc("sort_key"), F.desc(FILE_PATH)]
    newest = latest_per_key(placed, list(feed.business_key), order).select(*names)
    if feed.partition_by:
        parts, folder = list(feed.partition_by), table.current()
        if folder is None:
            table.create_partitioned(newest, parts)
        else:
            upsert_partitions(newest, folder, list(feed.business_key), parts, current=table.read())
    else:
        write_stage(newest, table, "upsert", key=list(feed.business_key))


def _run_number(history: DataFrame | None, feed: Feed, batch_id: str) -> int:
    """The place of a batch among those of its feed; a repeated batch keeps its own."""
    if history is None:
        return 1
    own = history.filter(F.col("pipeline_name") == feed.name)
    found = own.agg(F.max(F.when(F.col("batch_id") == batch_id, F.col(RUN_NUMBER))).alias("kept"), F.max(RUN_NUMBER).alias("last")).first()
    return found.kept if found.kept is not None else (found.last or 0) + 1


def _anomalies(feed: Feed, valid: DataFrame, files: DataFrame, house: Warehouse, now: str, batch_id: str) -> DataFrame | None:
    """Verdicts of the batch's files, each against the runs before it; history is extended."""
    policy = feed.anomaly
    if policy is None:
        return None
    history = house.control("profile_history")
    if history is not None and RUN_NUMBER not in history.columns:
        history = history.withColumn(RUN_NUMBER, F.lit(0).cast("long"))
    number = _run_number(history, feed, batch_id)
    profiles = materialize(
        compute_profile(valid, list(policy.metrics), by=[FILE_PATH])
        .join(files.select(FILE_PATH, "run_id"), FILE_PATH, "inner")
        .select(
            F.col("run_id").alias("process_id"), F.lit(feed.name).alias("pipeline_name"),
            F.to_date(F.lit(now)).alias("run_date"), "row_count", "metrics", F.lit(number).cast("long").alias(RUN_NUMBER),
        ),
        "profiles",
    )
    known = profiles
    if history is not None:
        own = history.filter(F.col("pipeline_name") == feed.name).join(
            profiles.select("process_id"), "process_id", "left_anti"
        ).select(*profiles.columns)
        known = profiles.unionByName(
            top_per_key(own, ["pipeline_name"], [F.desc("run_date"), F.desc(RUN_NUMBER), F.desc("process_id")], policy.window)
        )
    verdicts = score_history(
        known, list(policy.metrics), method=policy.method, threshold=policy.threshold, window=policy.window
    ).join(profiles.select("process_id"), "process_id", "left_semi")
    verdicts = materialize(verdicts, "verdicts")
    house.log(profiles, "profile_history", batch_id, "all")
    return verdicts


def run_batch(
    spark: SparkSession,
    feed: Feed,
    path: str | list[str],
    house: Warehouse,
    *,
    now: str,
    batch_id: str | None = None,
    references: Mapping[str, tuple[DataFrame, str]] | None = None,
    gold_inputs: Mapping[str, DataFrame] | None = None,
    stop_after: str | None = None,
    strict_names: bool = True,
) -> BatchResult:
    """Runs all files of a feed through the layers up to ``stop_after``.

    Content that reached the asked layer before is skipped and reported with its existing run
    id. Content that only landed, because its batch failed or stopped there, is not landed again:
    its whole batch is finished from bronze, under its own ids. Repeating a batch id replaces its
    own rows. Files that cannot be read are ``failed`` by themselves; with ``on_earlier_failure="stop"`` those
    behind the first of them are ``skipped`` and run with the next batch. Any other failing step, or a batch without
    a readable file, is recorded as ``failed`` and raised. All that a batch writes becomes visible at its
    end, also for a batch that died and is finished later; what a dead batch of the feed left is taken back first, so
    a feed may have one run at a time.
    """
    layers = layers_to_run(stop_after or feed.stop_after)
    with scratch_folders(spark):
        return _run_batch(
            spark, feed, path, house.writing(), layers, now=now, batch_id=batch_id or uuid.uuid4().hex, references=references,
            gold_inputs=gold_inputs, strict_names=strict_names,
        )


def _run_rows(files: DataFrame, status: Column, layer: Column, rows_in: Column, rows_out: Column, why: Column) -> DataFrame:
    return files.select(
        "run_id", FILE_PATH, FILE_CHECKSUM, status.alias("status"), layer.alias("layer_reached"),
        rows_in.cast("long").alias("rows_in"), rows_out.cast("long").alias("rows_out"), why.alias("failure_reasons"),
    )


def _own_runs(house: Warehouse, feed: Feed, batch_id: str) -> DataFrame | None:
    """Run rows of this feed from other committed batches, without the notes about skipped files."""
    log = house.control("runs")
    if log is None:
        return None
    log = log.filter(~F.col("batch_id").isin(sorted(house.journal.hidden())))
    return log.filter((F.col("pipeline_name") == feed.name) & (F.col("batch_id") != batch_id) & (F.col("status") != "skipped"))


def _judged(runs: DataFrame, layers: tuple[str, ...]) -> DataFrame:
    """Runs that need no further work: they reached the last of ``layers``, or checks stopped them behind bronze."""
    enough = F.col("layer_reached").isin(list(_LAYERS[_LAYERS.index(layers[-1]):]))
    stopped = (F.col("status") == "quarantined") & F.col("layer_reached").isNotNull()
    return runs.filter(((F.col("status") == "succeeded") & enough) | stopped)


def _unfinished(house: Warehouse, feed: Feed, hashed: DataFrame, layers: tuple[str, ...], batch_id: str) -> list[str]:
    """Other batches whose content is listed again and has landed, but is in no silver table or not committed yet.

    One id per batch that failed or stopped early; batches that went through are sorted out before.
    """
    log = house.control("landed_files")
    if log is None:
        return []
    landed = log.filter((F.col("pipeline_name") == feed.name) & (F.col("batch_id") != batch_id))
    landed = landed.join(hashed.select(FILE_CHECKSUM).distinct(), FILE_CHECKSUM, "left_semi")
    runs = _own_runs(house, feed, batch_id)
    if layers[-1] == "raw":
        # What landed is enough, if it was committed.
        landed = landed.filter(F.col("batch_id").isin(sorted(house.journal.hidden())))
    elif runs is not None:
        landed = landed.join(_judged(runs, layers[:2]).select(FILE_CHECKSUM).distinct(), FILE_CHECKSUM, "left_anti")
    found = landed.groupBy("batch_id").agg(F.min("sort_key").alias("at")).orderBy("at", "batch_id").collect()
    present = partition_folders(house.spark, house.bronze(feed.name), "batch_id")
    return [r.batch_id for r in found if r.batch_id in present]


def _resume(
    spark: SparkSession, feed: Feed, house: Warehouse, layers: tuple[str, ...], now: str, batch_id: str,
    references: Mapping[str, tuple[DataFrame, str]] | None, gold_inputs: Mapping[str, DataFrame] | None,
) -> None:
    """Takes a landed batch from bronze through the later layers, under its own batch and run ids."""
    log = house.control("landed_files").filter((F.col("pipeline_name") == feed.name) & (F.col("batch_id") == batch_id))
    files = materialize(log.select(*_LANDED), "files")
    steps = _Steps(house, feed, batch_id, files, F.lit(now).cast("timestamp"), part="resumed")
    steps.current = "stage"
    with _one_commit(house, feed, layers, batch_id), steps.recorded():
        bronze = read_batch(spark, house.bronze(feed.name), batch_id)
        if "stage" in layers:
            steps.write("stage-begin", steps.begin(files, "stage", f"silver.{feed.name}"))
            done = reduce(DataFrame.unionByName, _silver_and_gold(spark, feed, files, bronze, house, steps, layers, now, references, gold_inputs))
        else:
            done = _raw_runs(_counted(files, bronze))
        done = done.select("*", F.lit(feed.name).alias("pipeline_name"), F.lit(now).cast("timestamp").alias("started_at"))
        earlier = house.control("runs")
        if earlier is not None:
            # Files that a gate stopped keep their rows.
            earlier = earlier.filter(F.col("batch_id") == batch_id).join(files.select("run_id"), "run_id", "left_anti")
            done = done.unionByName(earlier.select(*done.columns))
        house.log(materialize(done, "runs"), "runs", batch_id, "all")
        steps.write_lineage()


@contextmanager
def _one_commit(house: Warehouse, feed: Feed, layers: tuple[str, ...], batch_id: str) -> Iterator[None]:
    """Makes the writes inside visible together at the end; an exception takes them back, but not what was landed."""
    places = [f"silver/{feed.name}"] if "stage" in layers else []
    places += [f"gold/{b.name}" for b in feed.gold if b.materialized != "view"] if "gold" in layers else []
    house.begin(batch_id, feed.name, places)
    try:
        yield
    except Exception:
        house.undo(batch_id, FAILED_BATCH)
        raise
    house.journal.commit(batch_id)


def _counted(files: DataFrame, bronze: DataFrame) -> DataFrame:
    """Files with the number of their bronze rows."""
    counted = files.join(bronze.groupBy(FILE_PATH).agg(F.count(F.lit(1)).alias("rows_in")), FILE_PATH, "left")
    return counted.withColumn("rows_in", F.coalesce("rows_in", F.lit(0)))


def _raw_runs(landed: DataFrame) -> DataFrame:
    rows = F.col("rows_in")
    return _run_rows(landed, F.lit("succeeded"), F.lit("raw"), rows, rows, F.array().cast("array<string>"))


def _run_batch(
    spark: SparkSession, feed: Feed, path: str | list[str], house: Warehouse, layers: tuple[str, ...], *, now: str, batch_id: str,
    references: Mapping[str, tuple[DataFrame, str]] | None, gold_inputs: Mapping[str, DataFrame] | None, strict_names: bool,
) -> BatchResult:

    found = discover(spark, feed, path, strict=strict_names)
    for dead in house.journal.open_batches(feed.name):
        house.undo(dead)
    if feed.skip_known_content or FILE_CHECKSUM in feed.metadata:
        sums = file_checksums(spark, [r.path for r in found.select("path").collect()])
        empty = F.when(F.col("length") == 0, F.sha2(F.lit(""), 256))
        found = found.join(sums, FILE_PATH, "left").withColumn(FILE_CHECKSUM, F.coalesce(FILE_CHECKSUM, empty))
    else:
        found = found.withColumn(FILE_CHECKSUM, F.lit(None).cast("string"))
    hashed = new = materialize(found, "hashed")
    resumed: list[str] = []
    if feed.skip_known_content:
        resumed = _unfinished(house, feed, hashed, layers, batch_id)
        for other in resumed:
            _resume(spark, feed, house, layers, now, other, references, gold_inputs)
        log = house.control("landed_files")
        log = None if log is None else log.filter(F.col("pipeline_name") == feed.name)
        # A repeated batch must not count as known content, so its own files are left out.
        known = landed_checksums(spark, house.bronze(feed.name), log, batch_id=batch_id)
        runs = _own_runs(house, feed, batch_id)
        if runs is not None:
            through = _judged(runs, layers).select(FILE_CHECKSUM)
            known = through if known is None else known.unionByName(through)
        new = checksum_dedup(hashed, known)
    # Run ids of a batch sort like its files do.
    run_id = F.concat(
        F.lit(batch_id + "-"), F.date_format("sort_key", "yyyyMMddHHmmssSSSSSS"), F.lit("-"), F.md5(FILE_PATH)
    )
    new = materialize(new.withColumn("run_id", run_id), "files")
    steps = _Steps(house, feed, batch_id, new, F.lit(now).cast("timestamp"))
    with _one_commit(house, feed, layers, batch_id), steps.recorded():
        return _run_layers(spark, feed, new, hashed, house, steps, layers, now, batch_id, references, gold_inputs, resumed)


def _land(spark: SparkSession, feed: Feed, files: DataFrame, house: Warehouse, now: str, batch_id: str) -> DataFrame:
    filled = [r.path for r in files.filter("length > 0").select("path").collect()]
    if not filled:
        raise ValueError(f"{feed.name}: the files hold no data")
    rows = read_records(spark, feed.fmt, filled, **feed.reader)
    # Logged first: files count as landed once the batch is in bronze too, and can then be resumed from there.
    house.log(files.select(F.lit(feed.name).alias("pipeline_name"), *_LANDED), "landed_files", batch_id, "all")
    return land_bronze(rows, files, house.bronze(feed.name), batch_id=batch_id, now=now, metadata=feed.metadata)


def unreadable_files(spark: SparkSession, feed: Feed, files: DataFrame) -> dict[str, str]:
    """Files that the feed's reader fails on, with the first line of the error.

    Only called when a batch could not be read. Halves of the list are tried until the files
    are found, so k bad ones among n take about k * log2(n) reads.
    """
    found: dict[str, str] = {}
    open_lists = [[r.path for r in files.filter("length > 0").orderBy("path").select("path").collect()]]
    while open_lists:
        paths = open_lists.pop()
        try:
            read_records(spark, feed.fmt, paths, **feed.reader).write.format("noop").mode("overwrite").save()
        except Exception as problem:
            if len(paths) == 1:
                found[paths[0]] = (str(problem).strip() or type(problem).__name__).splitlines()[0]
            else:
                open_lists += [paths[: len(paths) // 2], paths[len(paths) // 2 :]]
    return found


def _run_layers(
    spark: SparkSession, feed: Feed, new: DataFrame, hashed: DataFrame, house: Warehouse, steps: _Steps,
    layers: tuple[str, ...], now: str, batch_id: str,
    references: Mapping[str, tuple[DataFrame, str]] | None, gold_inputs: Mapping[str, DataFrame] | None, resumed: list[str],
) -> BatchResult:
    at = F.lit(now).cast("timestamp")
    raw_name, stage_name = f"bronze.{feed.name}", f"silver.{feed.name}"
    no_layer = F.lit(None).cast("string")

    def finish(*runs: DataFrame) -> BatchResult:
        log = reduce(DataFrame.unionByName, [*runs, *_known_rows(feed, new, hashed, house, steps, layers, now, resumed, gold_inputs, runs)])
        log = log.select("*", F.lit(feed.name).alias("pipeline_name"), at.alias("started_at"))
        house.log(materialize(log, "runs"), "runs", batch_id, "all")
        steps.write_lineage()
        return BatchResult(batch_id, house.control("runs").filter(F.col("batch_id") == batch_id))

    # Gate
    paths = [r.path for r in new.select("path").collect()]
    if not paths:
        return finish()
    # Without bounds on the rows the files are not read for counting.
    counts = line_counts(spark, paths) if feed.row_count != _ANY else None
    gated = materialize(
        control_gates(
            new, counts, size=feed.file_size, rows=feed.row_count, fmt=feed.fmt,
            columns=feed.reader.get("columns") if feed.fmt == "fixed_width" else None,
            header=bool(feed.reader.get("header", False)),  # only a header that was stated is no row
        ),
        "gated",
    )
    passed = gated.filter("passed")
    gate_state = F.when(F.col("passed"), "complete").otherwise("quarantined")
    began = steps.begin(new, "control_gate", raw_name)
    ended = steps.event(
        gated, "control_gate", raw_name, gate_state, F.col("row_count"), F.when(F.col("passed"), F.col("row_count")).otherwise(0)
    )
    steps.write("gate", began, ended, steps.begin(passed, "raw", raw_name))
    steps.lineage(gated, "control_gate", F.when(F.col("passed"), "COMPLETE").otherwise("FAIL"), F.col(FILE_PATH), FILE_PATH)
    if quarantine_files(spark, gated, house.folder("quarantined_files"), now=now, pipeline_name=feed.name, batch_id=batch_id):
        steps.alert(alert_ops.gate_alerts(gated), "gate")
    rejected = _run_rows(
        gated.filter(~F.col("passed")), F.lit("quarantined"), no_layer, F.col("row_count"), F.lit(0), F.col("failures")
    )

    # Bronze
    steps.current, steps.running = "raw", passed
    if passed.isEmpty():
        return finish(rejected)
    stopped: list[DataFrame] = []
    try:
        bronze = _land(spark, feed, passed, house, now, batch_id)
    except Exception as problem:
        broken = unreadable_files(spark, feed, passed)
        if not broken or passed.count() == len(broken):
            raise problem
        # The other files of the batch run, unless they have to wait for the broken one.
        errors = spark.createDataFrame(list(broken.items()), "path string, error string")
        state = F.when(F.col("error").isNotNull(), "failed").otherwise("ready")
        marked = passed.join(errors, "path", "left").withColumn("status", state).withColumn("batch_id", F.lit(batch_id))
        marked = materialize(batch_outcomes(materialize(marked, "marked"), feed.on_earlier_failure), "outcomes")
        failed, waiting = marked.filter("outcome = 'failed'"), marked.filter("outcome = 'skipped'")
        passed = marked.filter("outcome = 'ready'").select(*passed.columns)
        none = F.lit(None)
        steps.write("raw-failed", steps.event(failed, "raw", raw_name, F.lit("failed"), none, none))
        steps.lineage(failed, "raw", F.lit("FAIL"), F.col(FILE_PATH), raw_name)
        stopped = [
            _run_rows(failed, F.lit("failed"), no_layer, none, F.lit(0), F.array("error")),
            _run_rows(waiting, F.lit("skipped"), no_layer, none, F.lit(0), F.array(F.lit("an earlier file of the batch failed"))),
        ]
        if passed.isEmpty():
            return finish(rejected, *stopped)
        steps.running = passed
        bronze = _land(spark, feed, passed, house, now, batch_id)
    landed = _counted(passed, bronze)
    complete = steps.event(landed, "raw", raw_name, F.lit("complete"), F.col("rows_in"), F.col("rows_in"))
    steps.write("raw", complete, *([steps.begin(passed, "stage", stage_name)] if "stage" in layers else []))
    steps.lineage(passed, "raw", F.lit("COMPLETE"), F.col(FILE_PATH), raw_name)
    if "stage" not in layers:
        return finish(rejected, *stopped, _raw_runs(landed))

    return finish(rejected, *stopped, *_silver_and_gold(spark, feed, passed, bronze, house, steps, layers, now, references, gold_inputs))


def _known_rows(
    feed: Feed, new: DataFrame, hashed: DataFrame, house: Warehouse, steps: _Steps, layers: tuple[str, ...], now: str,
    resumed: list[str], gold_inputs: Mapping[str, DataFrame] | None, runs: tuple[DataFrame, ...],
) -> list[DataFrame]:
    """Rows of listed files that did not run in this batch, with the run id their content already has.

    Content that waited in bronze shows what became of it; content that is in silver already is
    taken to gold where that is asked for; the rest is skipped.
    """
    idle = hashed.join(new.select(FILE_PATH), FILE_PATH, "left_anti").select(FILE_PATH, FILE_CHECKSUM)
    older = _own_runs(house, feed, steps.batch_id)
    parts = [r.select(FILE_CHECKSUM, "run_id", "status", "layer_reached", "rows_in", "rows_out", "failure_reasons", F.lit(False).alias("now"), at)
             for r, at in [(r, F.lit(None).cast("timestamp").alias("started_at")) for r in runs]]
    if older is not None:
        parts.append(
            older.select(
                FILE_CHECKSUM, "run_id", "status", "layer_reached", "rows_in", "rows_out", "failure_reasons",
                F.col("batch_id").isin(resumed).alias("now"), "started_at",
            )
        )
    if not parts:
        return [_run_rows(idle.withColumn("run_id", F.lit(None).cast("string")), F.lit("skipped"), F.lit(None).cast("string"), F.lit(None), F.lit(0), F.array().cast("array<string>"))]
    reached = F.array_position(F.array(*map(F.lit, _LAYERS)), F.coalesce("layer_reached", F.lit("")))
    best = reduce(DataFrame.unionByName, parts).groupBy(FILE_CHECKSUM).agg(
        F.max_by(F.struct("run_id", "status", "layer_reached", "rows_in", "rows_out", "failure_reasons", "now"), F.struct(reached, "now", "started_at")).alias("run")
    )
    found = materialize(idle.join(best, FILE_CHECKSUM, "left").select(FILE_PATH, FILE_CHECKSUM, "run.*"), "known")
    waiting = found.filter((F.col("status") == "succeeded") & (F.col("layer_reached") == "stage") & ~F.col("now"))
    to_gold = "gold" in layers and bool(feed.gold) and older is not None
    if to_gold and not waiting.isEmpty():
        _build_gold(feed, waiting, house, steps, now, gold_inputs)
    fresh = F.coalesce("now", F.lit(False))
    lifted = (F.col("status") == "succeeded") & (F.col("layer_reached") == "stage") & ~fresh & F.lit(to_gold)
    status = F.when(lifted | fresh, F.col("status")).otherwise("skipped")
    layer = F.when(lifted, "gold").otherwise(F.col("layer_reached"))
    counted = lifted | fresh
    why = F.when(fresh, F.col("failure_reasons")).otherwise(F.array().cast("array<string>"))
    return [_run_rows(found, status, layer, F.when(counted, F.col("rows_in")), F.when(counted, F.col("rows_out")).otherwise(0), why)]


def _build_gold(
    feed: Feed, files: DataFrame, house: Warehouse, steps: _Steps, now: str, gold_inputs: Mapping[str, DataFrame] | None
) -> None:
    steps.current, steps.running = "gold", files
    inputs = {feed.name: house.stage(feed.name).read(), **(gold_inputs or {})}
    for build in feed.gold:
        gold_name = f"gold.{build.name}"
        began = steps.begin(files, "gold", gold_name)
        run_gold_build(build, inputs, house.gold(build.name, build.materialized), now=now)
        ended = steps.event(files, "gold", gold_name, F.lit("complete"), F.col("rows_out"), F.col("rows_out"))
        steps.write(gold_name, began, ended)
        steps.lineage(files, "gold", F.lit("COMPLETE"), F.lit(f"silver.{feed.name}"), gold_name)


def _silver_and_gold(
    spark: SparkSession, feed: Feed, passed: DataFrame, bronze: DataFrame, house: Warehouse, steps: _Steps, layers: tuple[str, ...],
    now: str, references: Mapping[str, tuple[DataFrame, str]] | None, gold_inputs: Mapping[str, DataFrame] | None,
) -> list[DataFrame]:
    """Checks the bronze rows of one batch and writes silver, quarantine and gold; the run rows of its files."""
    raw_name, stage_name, batch_id = f"bronze.{feed.name}", f"silver.{feed.name}", steps.batch_id
    rules = list(feed.rules)
    no_reasons = F.array().cast("array<string>")

    # Silver
    steps.current = "stage"
    indexed = with_row_index(bronze)
    if FILE_NAME not in indexed.columns:
        indexed = indexed.withColumn(FILE_NAME, F.substring_index(FILE_PATH, "/", -1))
    checked = materialize(
        check_rows(
            indexed, rules, lookups=references, business_key=list(feed.business_key) or None,
            group_by=list(feed.group_by) if feed.integrity_mode == "group_level" and feed.group_by else None,
        ),
        "checked", partition_by=(FAILED,),
    )
    valid, bad = split_batch(checked, rules, feed.integrity_mode)
    each = distinct_reasons(bad, [FILE_PATH])
    outcome = materialize(
        passed.join(
            checked.groupBy(FILE_PATH).agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(FAILED).alias("bad")), FILE_PATH, "left"
        )
        .join(each.groupBy(FILE_PATH).agg(F.sort_array(F.collect_set("reason")).alias("why")), FILE_PATH, "left")
        .withColumn("rows_in", F.coalesce("rows_in", F.lit(0)))
        .withColumn("bad", F.coalesce("bad", F.lit(0)))
        .withColumn("blocked", F.lit(feed.integrity_mode == "strict") & (F.col("bad") > 0))
        .withColumn("rows_out", F.when(F.col("blocked"), 0).otherwise(F.col("rows_in") - F.col("bad")))
        .withColumn("why", F.coalesce("why", no_reasons)),
        "outcome",
    )
    if not outcome.filter("bad > 0").isEmpty():
        house.log(
            quarantine_rows(bad, pipeline_name=feed.name, batch_id=batch_id, now=now).drop("batch_id"), "quarantine", batch_id, "all"
        )
        house.log(each, "run_reasons", batch_id, "all")
        steps.alert(alert_ops.row_alerts(bad, feed.integrity_mode), "rows")
    promoted, blocked = outcome.filter(~F.col("blocked")), outcome.filter("blocked")
    # A blocked file leaves the silver table alone, also where it would replace it.
    if not promoted.isEmpty():
        _write_stage(feed, valid, promoted, house.stage(feed.name, feed.buckets), batch_id)

    # Anomalies
    promoted = promoted.withColumn("held", F.lit(False))
    verdicts = _anomalies(feed, valid, outcome, house, now, batch_id)
    if verdicts is not None:
        messages = anomaly_messages(verdicts)
        steps.alert(messages.select(F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("long").alias("row_index"), "message"), "anomaly")
        if feed.anomaly.on_anomaly == "quarantine":
            texts = anomaly_reasons(verdicts).groupBy(F.col("process_id").alias("run_id")).agg(
                F.sort_array(F.collect_set("reason")).alias("texts")
            )
            promoted = promoted.drop("held").join(texts, "run_id", "left").withColumn("held", F.col("texts").isNotNull())
            promoted = promoted.withColumn("why", F.coalesce("texts", "why"))
    held = F.col("held")
    steps.write(
        "stage",
        steps.event(blocked, "stage", stage_name, F.lit("quarantined"), F.col("rows_in"), F.lit(0)),
        steps.event(
            promoted, "stage", stage_name, F.when(held, "quarantined").otherwise("complete"), F.col("rows_in"), F.col("rows_out")
        ),
    )
    steps.lineage(blocked, "stage", F.lit("FAIL"), F.lit(raw_name), stage_name)
    # One row a column of the feed.
    edges = raw_to_stage_edges(spark, rules, list(feed.business_key), raw_name, stage_name).collect()
    if edges:
        house.log(spark.createDataFrame(edges), "lineage_edges", batch_id, "all")
    fields = [(raw_name, c, "string") for c in data_columns(bronze.columns)]
    fields += [(stage_name, f.name, f.dataType.simpleString()) for f in valid.schema.fields if f.name in set(data_columns(valid.columns))]
    known = [(stage_name, e.target_column, raw_name, e.source_column, e.transformation) for e in edges]
    steps.lineage(
        promoted, "stage", F.when(held, "FAIL").otherwise("COMPLETE"), F.lit(raw_name), stage_name, fields=fields, columns=known
    )

    # Gold
    to_gold = promoted.filter(~held)
    reached = "stage"
    if "gold" in layers and feed.gold and not to_gold.isEmpty():
        _build_gold(feed, to_gold, house, steps, now, gold_inputs)
        reached = "gold"

    done = _run_rows(
        promoted, F.when(held, "quarantined").otherwise("succeeded"), F.when(held, "stage").otherwise(reached),
        F.col("rows_in"), F.col("rows_out"), F.col("why"),
    )
    stopped = _run_rows(blocked, F.lit("quarantined"), F.lit("raw"), F.col("rows_in"), F.lit(0), F.col("why"))
    return [done, stopped]
