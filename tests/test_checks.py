import pytest
from pyspark.sql import functions as F

from tierline.operators import checks
from tierline.operators.checks import (
    REASONS, Rule, apply_casts, check_rows, distinct_reasons, split_batch, unexpected_sample, validation_summary,
)

RULES = [
    Rule("account_id", ("not_null", "non_empty")),
    Rule("quantity", ("not_null", "is_numeric", {"greater_than_or_equal": 0}), "decimal", 18, 4),
    Rule("as_of_date", ("valid_date",), "date", format="%Y%m%d"),
]
KEY = ["account_id", "as_of_date"]


def frame(spark, rows, file="f1"):
    data = [(a, q, d, r[3] if len(r) > 3 else file, i) for i, r in enumerate(rows) for a, q, d in [r[:3]]]
    return spark.createDataFrame(
        data, "account_id string, quantity string, as_of_date string, file_path string, _row_index long"
    )


def reasons(df):
    return {r._row_index: list(r[REASONS]) for r in df.collect() if r[REASONS]}


@pytest.fixture(params=[1, 1_000_000], ids=["hot", "cold"])
def hot_rows(request):
    """Every key hot, and no key hot: both join paths must agree."""
    return request.param


def test_row_level(spark, hot_rows):
    df = frame(spark, [("ACC01", "100.0000", "20260101"), ("ACC02", "-5.0000", "20260101"), ("", "200.0000", "notadate")])
    checked = check_rows(df, RULES, business_key=KEY, hot_rows=hot_rows)
    assert reasons(checked) == {
        1: ["quantity: greater_than_or_equal"], 2: ["account_id: non_empty", "as_of_date: valid_date"],
    }
    valid, bad = split_batch(checked, RULES, "row_level")
    row = valid.first()
    assert valid.count() == 1 and str(row.quantity) == "100.0000" and str(row.as_of_date) == "2026-01-01"
    assert dict(valid.dtypes)["quantity"] == "decimal(18,4)"
    assert [r.quantity for r in bad.orderBy("_row_index").collect()] == ["-5.0000", "200.0000"]


def test_null_passes_all_but_not_null(spark):
    df = frame(spark, [(None, None, None)])
    assert reasons(check_rows(df, RULES)) == {0: ["account_id: not_nullable", "quantity: not_nullable"]}


@pytest.mark.parametrize("text,ok", [
    ("1", True), ("-1.5", True), (".5", True), ("1.", True), ("1e3", True), ("+2E-1", True),
    ("1d", False), (" 1 ", False), ("1_000", False), ("", False), ("abc", False), ("1,5", False),
])
def test_numbers(spark, text, ok):
    df = frame(spark, [("A", text, "20260101")])
    rule = [Rule("quantity", ("is_numeric",))]
    assert (reasons(check_rows(df, rule)) == {}) is ok


@pytest.mark.parametrize("fmt,text,ok", [
    ("%Y%m%d", "20260230", False), ("%m/%d/%Y", "1/5/2026", True), ("%m/%d/%Y", "01/05/2026", True),
    ("%Y-%m-%d", "2026-01-05", True), ("%Y%d%m", "20263101", True), ("%Y%d%m", "20261331", False),
])
def test_dates(spark, fmt, text, ok):
    df = frame(spark, [("A", "1", text)])
    assert (reasons(check_rows(df, [Rule("as_of_date", ("valid_date",), format=fmt)])) == {}) is ok


def test_comparisons_need_a_number(spark):
    df = frame(spark, [("A", "x", ""), ("A", "5", ""), ("A", "6", "")])
    rule = [Rule("quantity", ({"less_than": 6}, {"greater_than": 4}, {"less_than_or_equal": 5}))]
    assert reasons(check_rows(df, rule)) == {
        0: ["quantity: less_than", "quantity: greater_than", "quantity: less_than_or_equal"],
        2: ["quantity: less_than", "quantity: less_than_or_equal"],
    }


def test_duplicates_after_the_first(spark, hot_rows):
    df = frame(spark, [("ACC01", "1", "20260101"), ("ACC02", "1", "20260101"), ("ACC01", "-5", "20260101"), (None, "1", None), (None, "1", None)])
    rules = [Rule("quantity", ({"greater_than_or_equal": 0},))]
    assert reasons(check_rows(df, rules, business_key=KEY, hot_rows=hot_rows)) == {
        2: ["quantity: greater_than_or_equal", "duplicate business key: (account_id='ACC01', as_of_date='20260101')"],
        4: ["duplicate business key: (account_id=None, as_of_date=None)"],
    }


def test_duplicates_are_per_file(spark, hot_rows):
    df = frame(spark, [("A", "1", "20260101", "f1"), ("A", "1", "20260101", "f2")])
    assert reasons(check_rows(df, [], business_key=KEY, hot_rows=hot_rows)) == {}


def test_group_cascade_with_duplicates(spark, hot_rows):
    df = frame(spark, [("ACC01", "1", "20260101"), ("ACC01", "1", "20260102"), ("ACC01", "-5", "20260103"), ("ACC02", "1", "20260101")])
    checked = check_rows(df, RULES, business_key=KEY, group_by=["account_id"], hot_rows=hot_rows)
    swept = "quarantined with group (account_id='ACC01') - another row in this group failed DQ"
    assert reasons(checked) == {0: [swept], 1: [swept], 2: ["quantity: greater_than_or_equal"]}


def test_key_text_is_quoted(spark):
    df = frame(spark, [("O'Neil", "1", 'a"b'), ("O'Neil", "1", 'a"b')])
    assert reasons(check_rows(df, [], business_key=KEY)) == {
        1: ["duplicate business key: (account_id=\"O'Neil\", as_of_date='a\"b')"]
    }


def test_lookup_both_ways(spark, hot_rows, monkeypatch):
    df = frame(spark, [("USD", "1", ""), ("ZZZ", "1", ""), (None, "1", ""), ("ZZZ", "2", "")])
    ref = spark.createDataFrame([("USD",), ("EUR",)], "currency_code string")
    rules = [Rule("account_id", ("not_null",), lookup="currencies")]
    want = {1: ["account_id: sql_lookup"], 2: ["account_id: not_nullable"], 3: ["account_id: sql_lookup"]}
    for small in (True, False):
        monkeypatch.setattr(checks, "is_small", lambda _df: small)
        got = check_rows(df, rules, lookups={"currencies": (ref, "currency_code")}, business_key=["account_id", "quantity"], hot_rows=hot_rows)
        assert reasons(got) == want
    with pytest.raises(ValueError, match="no reference"):
        check_rows(df, rules)


def test_strict_blocks_only_the_failing_file(spark, hot_rows):
    df = frame(spark, [("A", "1", "20260101", "good"), ("B", "-1", "20260101", "bad"), ("C", "1", "20260101", "bad")])
    valid, bad = split_batch(check_rows(df, RULES), RULES, "strict", hot_rows=hot_rows)
    assert [r.account_id for r in valid.collect()] == ["A"]
    assert [r.account_id for r in bad.collect()] == ["B"]
    with pytest.raises(ValueError):
        split_batch(df, RULES, "loose")


def test_cast_overflow_is_a_reason(spark):
    df = frame(spark, [("A", "123456", "20260101")])
    rules = [Rule("quantity", ("is_numeric",), "decimal", 5, 2)]
    assert reasons(check_rows(df, rules)) == {0: ["quantity: cast_failed"]}


def test_casts_round_half_up_and_skip_missing(spark):
    df = spark.createDataFrame([("1.005", "20260131")], "q string, d string")
    got = apply_casts(df, [Rule("q", cast_to="decimal", precision=10, scale=2), Rule("d", cast_to="date", format="%Y%d%m"), Rule("gone", cast_to="decimal")]).first()
    assert str(got.q) == "1.01" and got.d is None


def test_bad_rules(spark):
    with pytest.raises(ValueError):
        Rule("a", ("valid_date",))
    with pytest.raises(ValueError):
        Rule("a", cast_to="int")
    df = frame(spark, [("A", "1", "")])
    for rule in (Rule("account_id", ("nope",)), Rule("account_id", ({"equals": 1},)), Rule("account_id", ({"less_than": 1, "greater_than": 2},)), Rule("gone", ("not_null",))):
        with pytest.raises(ValueError):
            check_rows(df, [rule])


def test_registered_check(spark):
    checks.register_check("upper", lambda v, rule: v != F.upper(v))
    df = frame(spark, [("a", "1", ""), ("A", "1", "")])
    assert reasons(check_rows(df, [Rule("account_id", ("upper",))])) == {0: ["account_id: upper"]}


def test_summary_and_samples(spark):
    df = frame(spark, [("A", "1", "x"), ("", "-2", "y"), (None, "-1", "20260101")])
    got = {(r.column_name, r.check_name): (r.element_count, r.missing_count, r.unexpected_count) for r in validation_summary(df, RULES).collect()}
    assert got[("account_id", "not_nullable")] == (3, 1, 1)
    assert got[("quantity", "greater_than_or_equal")] == (3, 0, 2)
    sample = {r.check_name: list(r.sample_values) for r in unexpected_sample(df, RULES, n=1).collect()}
    assert sample == {"not_nullable": [None], "non_empty": [""], "greater_than_or_equal": ["-1"], "valid_date": ["x"]}


def test_distinct_reasons(spark):
    df = frame(spark, [("", "1", ""), ("", "2", "")])
    bad = check_rows(df, [Rule("account_id", ("non_empty",))])
    assert [r.reason for r in distinct_reasons(bad, ["file_path"]).collect()] == ["account_id: non_empty"]


def test_partition_property(spark, hot_rows):
    """Valid and quarantined rows together are the input, under a key that owns most rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id"))).alias("account_id"),
        F.when(F.col("id") % 7 == 0, "x").otherwise(F.col("id").cast("string")).alias("quantity"),
        F.lit("20260101").alias("as_of_date"), F.lit("f").alias("file_path"), F.col("id").alias("_row_index"),
    )
    checked = check_rows(df, RULES, business_key=KEY, hot_rows=hot_rows).persist()
    valid, bad = split_batch(checked, RULES, "row_level")
    assert valid.count() + bad.count() == 3000
    assert valid.filter("account_id = 'HOT'").count() == 1
    checked.unpersist()
