import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierline.operators import quarantine
from tierline.operators.bucket_table import BucketTable, Scd2Table
from tierline.operators.bronze import checksum_dedup, file_checksums, land_bronze, read_batch, run_dedup
from tierline.operators.export import export_table
from tierline.operators.gates import control_gates, line_counts
from tierline.operators.reference import CURRENCIES, ensure_currencies
from tierline.operators.scd2 import current_versions, scd2_changes, scd2_merge
from tierline.operators.stage import insert_missing, merge_upsert, upsert_partitions, write_stage
from tierline.operators.tables import LogTable, SnapshotTable
from tierline.sources import list_files, read_csv
from tierline.functions.spread import materialize, scratch_folders


def kv(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_write_modes(spark, tmp_path, rows_of):
    t = SnapshotTable(spark, f"file:{tmp_path}/t")
    assert t.read() is None
    write_stage(kv(spark, [("a", 1)]), t, "append")
    write_stage(kv(spark, [("a", 2)]), t, "append")
    assert rows_of(t.read()) == [("a", 1), ("a", 2)]
    write_stage(kv(spark, [("a", 1), ("b", 2)]), t, "truncate_load")
    assert rows_of(t.read()) == [("a", 1), ("b", 2)]
    up = kv(spark, [("b", 3), ("c", 4)])
    for _ in range(2):  # an upsert can be repeated
        write_stage(up, t, "upsert", key=["k"])
        assert rows_of(t.read()) == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(ValueError):
        write_stage(up, t, "replace")
    assert len(t.versions()) == 4
    t.drop_old(1)
    assert len(t.versions()) == 1 and t.read().count() == 3


def test_merge_takes_the_latest_of_several_files(spark, rows_of):
    src = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 7, 1), (None, 8, 1)], "k string, v int, at int")
    got = merge_upsert(kv(spark, [("a", 0), (None, 6)]).withColumn("at", F.lit(0)), src, ["k"], order=[F.desc("at")])
    assert rows_of(got, "k", "v") == [(None, 6), (None, 7), (None, 8), ("a", 2)]


def test_partitioned_upsert_rewrites_touched_partitions(spark, tmp_path, rows_of):
    path = f"file:{tmp_path}/p"
    first = spark.createDataFrame([(1, "a", 1), (2, "a", 1)], "d int, k string, v int")
    upsert_partitions(first, path, ["d", "k"], ["d"])
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "p" / "d=1").glob("*.parquet")}
    upsert_partitions(spark.createDataFrame([(2, "a", 5), (2, "b", 6)], first.schema), path, ["d", "k"], ["d"])
    assert rows_of(spark.read.parquet(path), "d", "k", "v") == [(1, "a", 1), (2, "a", 5), (2, "b", 6)]
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "p" / "d=1").glob("*.parquet")}
    for parts in (["v"], ["k"]):
        with pytest.raises(ValueError):
            upsert_partitions(first, path, ["d", "k"], parts)


def test_scratch_is_removed(spark):
    import os

    with scratch_folders(spark):
        kept = materialize(kv(spark, [("a", 1)]), "x")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.isdir(folder)


def test_insert_missing_and_currencies(spark, tmp_path, rows_of):
    assert rows_of(insert_missing(kv(spark, [("a", 1)]), kv(spark, [("a", 9), ("b", 2)]), ["k"])) == [("b", 2)]
    t = SnapshotTable(spark, f"file:{tmp_path}/ref")
    own = spark.createDataFrame([("USD", "my dollar")], "currency_code string, currency_name string")
    t.append(own)
    added = ensure_currencies(t)
    assert len(added) == len(CURRENCIES) - 1 == 30 and ensure_currencies(t) == []
    assert t.read().filter("currency_code = 'USD'").first().currency_name == "my dollar"


def test_checksums_and_dedup(spark, tmp_path):
    import hashlib

    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("x\n1\n")
    (tmp_path / "c.csv").write_text("x\n2\n")
    listing = list_files(spark, f"file:{tmp_path}").withColumn("sort_key", F.col("file_name"))
    sums = file_checksums(spark, f"file:{tmp_path}")
    manifest = materialize(listing.join(sums, "file_path"), "m")
    assert manifest.filter("file_name = 'a.csv'").first().file_checksum == hashlib.sha256(b"x\n1\n").hexdigest()
    assert [r.file_name for r in checksum_dedup(manifest, None).orderBy("file_name").collect()] == ["a.csv", "c.csv"]
    landed = manifest.filter("file_name = 'c.csv'").select("file_checksum")
    assert [r.file_name for r in checksum_dedup(manifest, landed).collect()] == ["a.csv"]
    by_line = file_checksums(spark, f"file:{tmp_path}", whole_file_bytes=0)
    assert by_line.select("file_checksum").distinct().count() == 2
    assert all(r.file_checksum.startswith("lines:") for r in by_line.collect())
    runs = manifest.filter("file_name = 'c.csv'").select(
        F.lit("p").alias("pipeline_name"), "file_checksum", F.lit("r1").alias("run_id"), F.current_timestamp().alias("started_at"), F.lit("failed").alias("status"))
    todo, known = run_dedup(manifest.withColumn("pipeline_name", F.lit("p")), runs)
    assert [r.file_name for r in todo.collect()] == ["a.csv"] and known.first().run_id == "r1"


def test_files_are_hashed_as_they_are_read(spark, tmp_path):
    """Beyond 16 MB no file becomes one value, however small the splits are; its digest is that of its bytes."""
    import hashlib

    line = b'{"order_id": "1", "customer": "2", "price": "3.00", "ordered_on": "20260101", "priority": "5-LOW"}\n'
    raw = {"a.json": line * 180_000, "b.json": b"\xef\xbb\xbf" + line * 180_000 + b"\xff\r\n\n\x00", "c.json": line}
    for name, content in raw.items():
        (tmp_path / name).write_bytes(content)
    limit = "spark.sql.sources.binaryFile.maxLength"
    try:
        spark.conf.set(limit, 16 * 1024 * 1024)
        sums = {r.file_path[-6:]: r.file_checksum for r in file_checksums(spark, f"file:{tmp_path}").collect()}
    finally:
        spark.conf.unset(limit)
    assert sums == {name: hashlib.sha256(content).hexdigest() for name, content in raw.items()}


def test_digests_of_streamed_files(spark, tmp_path):
    """Terminators, byte order marks, bytes that are no text, packed files and names that look like patterns."""
    import gzip
    import hashlib

    line = "".join(f"line {i}\n" for i in range(20)).encode()
    mark = b"\xef\xbb\xbf"
    raw = [line, line[:-1], line.replace(b"\n", b"\r\n"), mark + line, mark + line[:-1], mark + mark + line, line + b"\n\n", b"\n", b"x", b"\r", b"\xff\xfe\n\r\r\n\x00", line * 2000]
    names = {f"f{i:02}.csv": c for i, c in enumerate(raw)} | {"p.csv.gz": gzip.compress(line), "q{1}[a]*.csv": line, "r s%20.csv": line[:-1]}
    for name, content in names.items():
        (tmp_path / name).write_bytes(content)
    found = file_checksums(spark, f"file:{tmp_path}", value_bytes=0).join(list_files(spark, f"file:{tmp_path}"), "file_path")
    assert {r.file_name: r.file_checksum for r in found.collect()} == {name: hashlib.sha256(c).hexdigest() for name, c in names.items()}


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_large_files_keep_their_order_and_bytes(spark, tmp_path, monkeypatch, split):
    """Contents that differ only in line order, terminators or a byte order mark; files in splits and whole."""
    monkeypatch.setattr(quarantine, "_CHUNK_BYTES", 8)
    line = "".join(f"line {i}\n" for i in range(20))
    contents = [line, "".join(f"line {i}\n" for i in reversed(range(20))), line.replace("\n", "\r\n"), line[:-1], "\ufeff" + line, "\ufeff" + line[:-1],
                line + "\n", "x" * 50, "x" * 20 + "\n" * 5, b"\xff\xfe\n\r\r\n\x00", line]
    raw = [c if isinstance(c, bytes) else c.encode() for c in contents]
    for i, c in enumerate(raw):
        (tmp_path / f"f{i:02}.csv").write_bytes(c)
    src = f"file:{tmp_path}"
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        sums = [r.file_checksum for r in file_checksums(spark, src, whole_file_bytes=0).orderBy("file_path").collect()]
        spark.conf.set("spark.sql.files.maxPartitionBytes", 40)
        again = [r.file_checksum for r in file_checksums(spark, src, whole_file_bytes=0).orderBy("file_path").collect()]
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        gated = list_files(spark, src).withColumns({"passed": F.lit(False), "failures": F.array(F.lit("size"))})
        out = f"file:{tmp_path}/kept"
        assert quarantine.quarantine_files(spark, gated, out, now="2026-01-01", pipeline_name="p", batch_id="b", binary_bytes=0) == len(raw)
        chunks = spark.read.parquet(f"{out}/chunks").orderBy("file_path", "block", "position").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sums == again and len(set(sums)) == len(raw) - 1 and sums[0] == sums[-1]
    kept = {}
    for r in chunks:
        kept[r.file_path[-7:]] = kept.get(r.file_path[-7:], b"") + r.chunk
    assert kept == {f"f{i:02}.csv": c for i, c in enumerate(raw)}
    assert spark.read.parquet(f"{out}/large_files").count() == len(raw)


def test_bronze_batch_can_be_repeated(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a,b\n1,2\n3,4\n")
    src = f"file:{tmp_path}/in"
    manifest = materialize(list_files(spark, src).join(file_checksums(spark, src), "file_path"), "m")
    out = f"file:{tmp_path}/bronze"
    for batch in ("b1", "b1", "b2"):
        land_bronze(read_csv(spark, src), manifest, out, batch_id=batch, now="2026-01-01 00:00:00")
    table = spark.read.parquet(out)
    assert table.count() == 4 and read_batch(spark, out, "b1").count() == 2
    assert {t for c, t in table.dtypes if c in "ab"} == {"string"}
    assert table.filter("file_name = 'a.csv' and length(file_checksum) = 64").count() == 4
    with pytest.raises(ValueError, match="unknown metadata"):
        land_bronze(read_csv(spark, src), manifest, out, batch_id="x", now="2026-01-01", metadata=("nope",))


@pytest.mark.parametrize("text,fmt,header,want", [
    ("ACC01 1000\n" * 3, "fixed_width", False, 3), ("ACC01 1000\r\n" * 2, "fixed_width", False, 2),
    ("ACC01 1000", "fixed_width", False, 1), ("a,b\n1,2", "csv", False, 2), ("a,b\n1,2", "csv", True, 1),
    ("a,b\n1,2\n", "csv", True, 1), ("", "csv", True, 0), ('[{"a": 1}]', "json", True, 1),
])
def test_gate_rows(spark, tmp_path, text, fmt, header, want):
    (tmp_path / "f").write_bytes(text.encode())
    path = f"file:{tmp_path}"
    gated = control_gates(
        list_files(spark, path), line_counts(spark, path), size=(5, 1000), rows=(1, 2), fmt=fmt,
        columns=[("a", 1, 5), ("b", 7, 10)], header=header,
    ).filter("file_name = 'f'").first()
    assert gated.row_count == want
    expected = []
    if len(text) < 5:
        expected.append(f"file_size {len(text)} below min_bytes 5")
    if want < 1:
        expected.append(f"row_count {want} below min_rows 1")
    if want > 2:
        expected.append(f"row_count {want} above max_rows 2")
    assert gated.failures == expected and gated.passed == (not expected)


def test_unterminated_last_line_counts_when_exact(spark, tmp_path):
    (tmp_path / "f").write_text("A" * 65 + "\n" + "B" * 65)
    path = f"file:{tmp_path}"
    args = dict(size=(0, 10**6), rows=(0, 10), fmt="fixed_width", columns=[("a", 1, 65)])
    assert control_gates(list_files(spark, path), line_counts(spark, path), **args).first().row_count == 1
    assert control_gates(list_files(spark, path), line_counts(spark, path), exact=True, **args).first().row_count == 2


def test_export(spark, tmp_path):
    df = kv(spark, [("a", 1), ("b", 2)])
    first = export_table(df, "ns.t", location=f"file:{tmp_path}")
    second = export_table(df, "ns.t", location=f"file:{tmp_path}")
    assert (first.created, first.row_count, second.created, second.row_count) == (True, 2, False, 2)
    assert spark.read.parquet(f"file:{tmp_path}/ns/t").count() == 4
    for bad in (dict(table="t"), dict(table="ns.t", enabled=False)):
        with pytest.raises(ValueError):
            export_table(df, location=f"file:{tmp_path}", **bad)


def test_scd2_three_runs(spark, rows_of):
    run1 = scd2_merge(None, kv(spark, [("A", 1), ("B", 2)]), ["k"], ["v"], "2026-01-01 00:00:00")
    run2 = scd2_merge(run1, kv(spark, [("A", 1), ("B", 3), ("C", 5)]), ["k"], ["v"], "2026-01-02 00:00:00")
    changes = scd2_changes(run1, kv(spark, [("A", 1), ("B", 3), ("C", 5)]), ["k"], ["v"], "2026-01-02 00:00:00")
    assert rows_of(changes, "k", "v", "version", "active_flag") == [("B", 2, 1, False), ("B", 3, 2, True), ("C", 5, 1, True)]
    assert rows_of(run2, "k", "v", "version", "active_flag") == [
        ("A", 1, 1, True), ("B", 2, 1, False), ("B", 3, 2, True), ("C", 5, 1, True)]
    expired = run2.filter("k = 'B' and version = 1").first()
    assert expired.expiry_datetime == dt.datetime(2026, 1, 2) and expired.effective_datetime == dt.datetime(2026, 1, 1)
    run3 = scd2_merge(run2, kv(spark, [("A", 1), ("B", 3), ("C", 5)]), ["k"], ["v"], "2026-01-03 00:00:00")
    assert rows_of(run3) == rows_of(run2)
    run4 = scd2_merge(run3, kv(spark, [("B", None)]), ["k"], ["v"], "2026-01-04 00:00:00")
    assert rows_of(current_versions(run4), "k", "v", "version") == [("A", 1, 1), ("B", None, 3), ("C", 5, 1)]
    assert run4.columns == ["k", "v", "version", "effective_datetime", "expiry_datetime", "active_flag", "scd_pk"]
    import hashlib
    assert run1.filter("k = 'A'").first().scd_pk == hashlib.md5(b"A|1").hexdigest()
    with pytest.raises(Exception, match="NULL in a business key"):
        scd2_merge(run1, kv(spark, [(None, 1)]), ["k"], ["v"], "2026-01-02 00:00:00").collect()
    with pytest.raises(ValueError):
        scd2_merge(run1, run1, ["k"], ["k"], "2026-01-02 00:00:00")


def test_partitioned_upsert_keeps_rows_of_the_null_partition(spark, tmp_path, rows_of):
    path = f"file:{tmp_path}/silver"
    make = lambda rows: spark.createDataFrame(rows, "k string, day int, v int")
    upsert_partitions(make([("a", None, 1), ("b", None, 2), ("d", 3, 3)]), path, ["k", "day"], ["day"])
    upsert_partitions(make([("c", None, 4), ("d", 3, 5)]), path, ["k", "day"], ["day"])
    assert rows_of(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 2), ("c", 4), ("d", 5)]


def test_replaced_partitioned_table_stays_partitioned(spark, tmp_path):
    table = SnapshotTable(spark, f"file:{tmp_path}/t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, day int, v int")
    table.create_partitioned(rows(("a", 1, 1), ("b", None, 2)), ["day"])
    table.replace(merge_upsert(table.read(), rows(("a", 1, 9)), ["k", "day"]))
    upsert_partitions(rows(("c", None, 3), ("d", 1, 4)), table.current(), ["k", "day"], ["day"])
    assert sorted((r.k, r.day, r.v) for r in table.read().collect() if r.k != "x") == [("a", 1, 9), ("b", None, 2), ("c", None, 3), ("d", 1, 4)]


def test_upserts_touch_only_the_buckets_of_their_keys(spark, tmp_path):
    table = BucketTable(spark, f"file:{tmp_path}/t", buckets=8)
    assert table.read() is None and not table.exists()
    rows = spark.range(200).selectExpr("cast(id AS int) AS k", "concat('v', id) AS v").unionByName(spark.createDataFrame([(None, "a"), (None, "b")], "k int, v string"))
    table.upsert(rows, ["k"])
    first = table.manifest()
    # The key comes as a long: it is hashed as the table's type.
    change = spark.createDataFrame([(7, "old", 1), (7, "new", 2), (1000, "x", 1)], "k long, v string, at int")
    table.upsert(change, ["k"], order=[change["at"].desc()])
    second = table.manifest()
    assert second.version == 2 and 1 <= sum(first.folders[b] != second.folders[b] for b in first.folders) <= 2
    want = {i: f"v{i}" for i in range(200)} | {7: "new", 1000: "x"}
    got = [tuple(r) for r in table.read().collect()]
    assert dict(r for r in got if r[0] is not None) == want and len(got) == len(want) + 2
    assert table.read(1).count() == 202
    # Nothing to write: no version. A write that never committed is invisible and is swept.
    table.upsert(change.limit(0), ["k"])
    rows.write.parquet(f"file:{tmp_path}/t/data/lost")
    assert table.versions() == [1, 2] and table.read().count() == 203
    table.drop_old(1)
    assert table.versions() == [2] and table.read().count() == 203 and not (tmp_path / "t/data/lost").exists()
    with pytest.raises(ValueError):
        table.upsert(change, ["v"])
    with pytest.raises(RuntimeError):
        table._commit(second)


def test_history_without_changes_writes_nothing(spark, tmp_path):
    table = Scd2Table(spark, f"file:{tmp_path}/h", buckets=4)
    states = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")], [(3, "d")], [(2, "e"), (1, None)]]
    plain = None
    for day, rows in enumerate(states, 1):
        snapshot, now = spark.createDataFrame(rows, "k int, v string"), f"2026-01-0{day} 00:00:00"
        table.merge(snapshot, ["k"], ["v"], now)
        plain = scd2_merge(plain, snapshot, ["k"], ["v"], now)
        assert sorted(map(str, table.read().collect())) == sorted(map(str, plain.collect()))
    assert table.versions() == [1, 2, 3] and len(table.manifest().added) == 2
    files = {p for p in (tmp_path / "h").rglob("*.parquet")}
    table.merge(spark.createDataFrame(states[-1], "k int, v string"), ["k"], ["v"], "2026-01-09 00:00:00")
    assert {p for p in (tmp_path / "h").rglob("*.parquet")} == files
    table.drop_old(1)
    assert table.read().count() == plain.count()


def test_logs_keep_their_schema(spark, tmp_path):
    log = LogTable(spark, f"file:{tmp_path}/log")
    assert log.read() is None
    log.write(spark.createDataFrame([], "a int"), "007", "x")
    assert log.read().count() == 0 and log.read().columns == ["a", "batch_id"]
    log.write(spark.createDataFrame([(1,)], "a int"), "007", "x")
    log.write(spark.createDataFrame([(2, "s")], "a int, b string"), "8", "y")
    assert sorted(tuple(r) for r in log.read().select("a", "b", "batch_id").collect()) == [(1, None, "007"), (2, "s", "8")]
