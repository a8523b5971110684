import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tierline.functions.names import data_columns
from tierline.operators.rows import with_row_index
from tierline.sources import (
    list_files, match_file_pattern, read_csv, read_delimited, read_fixed_width, read_json_records, read_records,
    read_xml_records, require_matches, sample_table, select_files, staging_view, unmatched_files,
)
from tierline.sources.registry import read_records
from tierline.sources.files import NoMatchingFiles, file_sort_key, pattern_regex


def put(folder, name, text, mode="w"):
    path = folder / name
    with open(path, mode) as f:
        f.write(text)
    return f"file:{path}"


def data(df):
    cols = data_columns(df.columns)
    return cols, [tuple(r) for r in df.orderBy("file_path", "_scan_order").select(*[f"`{c}`" for c in cols]).collect()]


def test_csv_keeps_text_and_tells_empty_from_quoted_empty(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b,c\n001,,x\n1.50,"","say ""hi"""\n2,"p,q"\n')
    cols, rows = data(read_csv(spark, path))
    assert cols == ["a", "b", "c"]
    assert rows == [("001", None, "x"), ("1.50", "", 'say "hi"'), ("2", "p,q", None)]


def test_csv_ignores_a_configured_separator(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b\n1;2,3\n")
    assert data(read_csv(spark, path, sep=";"))[1] == [("1;2", "3")]


def test_delimited_without_header_numbers_columns(spark, tmp_path):
    path = put(tmp_path, "a.txt", "1|2\n3|4\n")
    assert data(read_delimited(spark, path, sep="|", header=False)) == (["column_1", "column_2"], [("1", "2"), ("3", "4")])


def test_more_fields_than_columns_stops_the_read(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b\n1,"x,y"\n1,2,3\n')
    with pytest.raises(Exception, match="more fields than columns"):
        read_csv(spark, path).collect()


def test_header_drift_between_files_stops_the_read(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b\n1,2\n")
    put(tmp_path, "b.csv", "a,c\n1,2\n")
    with pytest.raises(Exception):
        read_csv(spark, f"file:{tmp_path}", columns=["a", "b"]).collect()


def test_fixed_width_slices_and_strips(spark, tmp_path):
    path = put(tmp_path, "f.txt", "ACC01  100\r\n\n   \nACC02\nééééé  7\n")
    cols, rows = data(read_fixed_width(spark, path, [("acc", 1, 5), ("qty", 6, 10)]))
    assert rows == [("ACC01", "100"), ("ACC02", ""), ("é" * 5, "7")]
    with pytest.raises(ValueError):
        read_fixed_width(spark, path, [])


def test_row_index_over_many_splits(spark, tmp_path):
    n = 30000
    for name in ("one", "two"):
        put(tmp_path, name, "".join(f"A{i:06d}{name:>5}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_fixed_width(spark, f"file:{tmp_path}", [("id", 2, 7), ("name", 8, 12)])
        assert rows.rdd.getNumPartitions() > 10
        indexed = with_row_index(rows)
        assert indexed.count() == 2 * n
        assert indexed.filter(F.col("_row_index") != F.col("id").cast("long")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_forms(spark, tmp_path):
    put(tmp_path, "array.json", json.dumps([{"a": 1, "b": True, "n": None}, {"a": "x", "b": False, "n": "y"}]))
    assert data(read_json_records(spark, f"file:{tmp_path}/array.json")) == (
        ["a", "b", "n"], [("1", "true", None), ("x", "false", "y")])
    put(tmp_path, "one.json", '{"a": 1.50, "d": {"k": 1}, "l": [1, 2]}')
    assert data(read_json_records(spark, f"file:{tmp_path}/one.json"))[1] == [("1.50", '{"k": 1}', "[1, 2]")]
    put(tmp_path, "lines.json", '{"a": 1}\n{"a": 2}\n')
    assert data(read_json_records(spark, f"file:{tmp_path}/lines.json", lines=True))[1] == [("1",), ("2",)]
    put(tmp_path, "deep.json", json.dumps({"data": {"holdings": [{"q": 1}, {"q": 2}]}, "m": 3}))
    deep = f"file:{tmp_path}/deep.json"
    assert data(read_json_records(spark, deep, record_path="data.holdings"))[1] == [("1",), ("2",)]
    assert data(read_json_records(spark, deep, record_path="data.holdings", columns=["q", "z"]))[1] == [("1", None), ("2", None)]
    with pytest.raises(ValueError, match="not found"):
        read_json_records(spark, deep, record_path="data.nothing")
    with pytest.raises(ValueError, match="list of objects"):
        read_json_records(spark, deep, record_path="m")
    put(tmp_path, "single.json", json.dumps({"data": {"q": 5}}))
    assert data(read_json_records(spark, f"file:{tmp_path}/single.json", record_path="data"))[1] == [("5",)]


XML = """<Positions>
 <Position id="p1"><UniqueID>ID_001</UniqueID><Identifiers><ISIN>NL0010273215</ISIN></Identifiers>
  <Equity><Price><Amount ccy="EUR"> 941.18 </Amount></Price></Equity><Tag>a</Tag><Tag>b</Tag></Position>
 <Position id="p2"><UniqueID>  </UniqueID><Identifiers type="x"><ISIN>NL2</ISIN></Identifiers></Position>
</Positions>"""


def test_xml_is_flattened(spark, tmp_path):
    path = put(tmp_path, "p.xml", XML)
    df = read_xml_records(spark, path, ".//Position")
    got = [{c: r[c] for c in data_columns(df.columns)} for r in df.orderBy("`@id`").collect()]
    assert got[0]["@id"] == "p1" and got[0]["UniqueID"] == "ID_001"
    assert got[0]["Identifiers.ISIN"] == "NL0010273215"
    assert got[0]["Equity.Price.Amount"] == "941.18" and got[0]["Equity.Price.Amount@ccy"] == "EUR"
    assert got[0]["Tag"] == "b"
    assert got[1]["UniqueID"] is None and got[1]["Identifiers.@type"] == "x"
    assert read_xml_records(spark, path, ".//Nothing").count() == 0
    with pytest.raises(ValueError):
        read_xml_records(spark, path, "")


def test_registry(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a\n1\n")
    assert data(read_records(spark, "csv", path))[1] == [("1",)]
    with pytest.raises(ValueError, match="no reader"):
        read_records(spark, "nope", path)


def test_file_selection(spark, tmp_path):
    for i, name in enumerate(["H_20260301.txt", "H_20260303.txt", "H_20260302.txt", "other.xlsx", "H_bad.txt"]):
        put(tmp_path, name, "x" * (i + 1))
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    (tmp_path / "20260101").mkdir()
    put(tmp_path / "20260101", "H_20250101.txt", "x")
    listing = list_files(spark, f"file:{tmp_path}")
    assert listing.count() == 5
    assert [r.file_name for r in unmatched_files(listing, "H_{date}.txt").collect()] == ["other.xlsx"]

    def keyed(**kw):
        return file_sort_key(listing, "H_{date}.txt", order_by="filename_timestamp", ts_format="%Y%m%d", **kw)

    with pytest.raises(Exception, match="H_bad.txt"):
        keyed(strict=True).collect()
    lenient = keyed(strict=False)
    assert [r.token for r in select_files(lenient, "all", "desc").collect()] == ["20260303", "20260302", "20260301"]
    assert select_files(lenient, "latest").first().token == "20260303"
    assert select_files(lenient, "earliest").first().token == "20260301"
    arrival = file_sort_key(listing, "H_{date}.txt", order_by="arrival_time", ts_format=None, strict=True)
    assert select_files(arrival, "latest").first().file_name == "H_bad.txt"
    with pytest.raises(NoMatchingFiles) as caught:
        require_matches(listing, "Z_{date}.csv")
    assert "other.xlsx" in [r.file_name for r in caught.value.unmatched.collect()]
    present = listing.count()
    with pytest.raises(NoMatchingFiles, match=f"and {present - 1} more") as caught:
        require_matches(listing, "Z_{date}.csv", shown=1)
    assert caught.value.unmatched.count() == present


def test_pattern(spark):
    assert pattern_regex("H+{d}.txt") == r"^H\+(.+?)\.txt$"
    with pytest.raises(ValueError):
        pattern_regex("{a}{b}")
    df = spark.createDataFrame([("a.b.csv",), ("aXb.csv",)], "n string")
    got = df.select(match_file_pattern(F.col("n"), "a.b.csv").alias("m")).collect()
    assert [r.m for r in got] == ["", None]


def test_sample_and_view(spark):
    df = spark.range(100).selectExpr("id as a", "'f' as file_name", "'b' as batch_id")
    sample = sample_table(df, 10, seed=1)
    assert sample.columns == ["a"] and sample.count() == 10 and sample.distinct().count() == 10
    assert staging_view(df, {"a": "b"}).columns == ["b"]


def test_reserved_column_names_are_refused(spark, tmp_path):
    for header in ("_dq_x,v", "batch_id,v", "file_name,v"):
        (tmp_path / "r.csv").write_text(header + "\n1,2\n")
        with pytest.raises(Exception, match="reserved|uplicate|mbiguous"):
            read_records(spark, "csv", f"file:{tmp_path}/r.csv").collect()
