"""Row checks, duplicate keys, groups, lookups and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import joined, landed, money, query, table
from tierline.operators.alerts import row_alerts
from tierline.operators.checks import (
    FAILED, REASONS, Rule, apply_casts, blocked_files, check_rows, distinct_reasons, split_batch, unexpected_sample,
    validation_summary,
)

ORDER_RULES = [
    Rule("customer", ("not_null", "non_empty")),
    Rule("price", ("not_null", "is_numeric", {"greater_than_or_equal": 0}), "decimal", 18, 2),
    Rule("ordered_on", ("not_null", "valid_date"), "date", format="%Y%m%d"),
]

# The orders table as a feed would send it: text, with defects derived from the keys.
ORDERS_TEXT = """
    SELECT o_orderkey,
           CASE WHEN o_custkey % 97 = 0 THEN '' WHEN o_custkey % 89 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer,
           CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
                WHEN o_orderkey % 71 = 0 THEN 'n/a' WHEN o_orderkey % 73 = 0 THEN '1_000'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
           CASE WHEN o_orderkey % 61 = 0 THEN 'notadate' WHEN o_orderkey % 67 = 0 THEN '20260230'
                ELSE strftime(o_orderdate, '%Y%m%d') END AS ordered_on,
           o_orderpriority AS priority
    FROM orders
"""
# The conditions of ORDER_RULES in rule order.
ORDER_FAILS = r"""
    CASE WHEN customer IS NULL THEN 'customer: not_nullable' END,
    CASE WHEN customer = '' THEN 'customer: non_empty' END,
    CASE WHEN price IS NULL THEN 'price: not_nullable' END,
    CASE WHEN NOT regexp_full_match(price, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 'price: is_numeric' END,
    CASE WHEN price IS NOT NULL AND NOT COALESCE(CASE WHEN regexp_full_match(price, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
              THEN TRY_CAST(price AS DOUBLE) END >= 0, FALSE) THEN 'price: greater_than_or_equal' END,
    CASE WHEN ordered_on IS NULL THEN 'ordered_on: not_nullable' END,
    CASE WHEN ordered_on IS NOT NULL AND try_strptime(ordered_on, '%Y%m%d') IS NULL THEN 'ordered_on: valid_date' END
"""
ORDERS_CHECKED = f"WITH t AS ({ORDERS_TEXT}), c AS (SELECT *, concat_ws(';', {ORDER_FAILS}) AS reasons FROM t) "


def orders_text(spark: SparkSession, folder: str) -> DataFrame:
    key, price = F.col("o_orderkey"), money("o_totalprice").cast("string")
    cust = F.col("o_custkey")
    return landed(table(spark, folder, "orders").select(
        key.alias("o_orderkey"),
        F.when(cust % 97 == 0, "").when(cust % 89 == 0, None).otherwise(cust.cast("string")).alias("customer"),
        F.when(key % 41 == 0, None).when(key % 53 == 0, F.concat(F.lit("-"), price)).when(key % 71 == 0, "n/a")
        .when(key % 73 == 0, "1_000").otherwise(price).alias("price"),
        F.when(key % 61 == 0, "notadate").when(key % 67 == 0, "20260230")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("ordered_on"),
        F.col("o_orderpriority").alias("priority"),
        F.lit("orders").alias("file_path"),
        key.alias("_row_index"),
    ))


def orders_checked(spark: SparkSession, folder: str) -> DataFrame:
    return check_rows(orders_text(spark, folder), ORDER_RULES)


@query("dq_row_level", ORDERS_CHECKED + "SELECT o_orderkey, reasons FROM c")
def dq_row_level(spark: SparkSession, folder: str) -> DataFrame:
    return orders_checked(spark, folder).select("o_orderkey", joined(REASONS).alias("reasons"))


@query(
    "dq_split_rollup",
    ORDERS_CHECKED + """
    SELECT priority, count(*) AS valid_rows, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
           min(CAST(strptime(ordered_on, '%Y%m%d') AS DATE)) AS first_day
    FROM c WHERE reasons = '' GROUP BY priority""",
)
def dq_split_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Check, split, type, roll up: the shortest way through all layers."""
    valid, _ = split_batch(orders_checked(spark, folder), ORDER_RULES, "row_level")
    return valid.groupBy("priority").agg(
        F.count(F.lit(1)).alias("valid_rows"), F.sum("price").cast("double").alias("total_price"),
        F.min("ordered_on").alias("first_day"),
    )


@query("dq_quarantined_rows", ORDERS_CHECKED + "SELECT o_orderkey, customer, price, ordered_on, reasons FROM c WHERE reasons <> ''")
def dq_quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_batch(orders_checked(spark, folder), ORDER_RULES, "row_level")
    return bad.select("o_orderkey", "customer", "price", "ordered_on", joined(REASONS).alias("reasons"))


@query(
    "cast_stage",
    ORDERS_CHECKED + """
    SELECT o_orderkey, customer, CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price,
           CAST(strptime(ordered_on, '%Y%m%d') AS DATE) AS ordered_on FROM c WHERE reasons = ''""",
)
def cast_stage(spark: SparkSession, folder: str) -> DataFrame:
    checked = orders_checked(spark, folder).filter(~F.col(FAILED))
    return apply_casts(checked, ORDER_RULES).select(
        "o_orderkey", "customer", F.col("price").cast("double").alias("price"), "ordered_on"
    )


@query(
    "dq_comparisons",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(';',
         CASE WHEN NOT l_quantity > 2 THEN 'quantity: greater_than' END,
         CASE WHEN NOT l_quantity <= 49 THEN 'quantity: less_than_or_equal' END,
         CASE WHEN NOT CAST(l_discount AS DECIMAL(18,2)) < 0.1 THEN 'discount: less_than' END,
         CASE WHEN NOT CAST(l_tax AS DECIMAL(18,2)) >= 0.01 THEN 'tax: greater_than_or_equal' END) AS reasons
       FROM lineitem""",
)
def dq_comparisons(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money("l_quantity").cast("string").alias("quantity"),
        money("l_discount").cast("string").alias("discount"), money("l_tax").cast("string").alias("tax"),
    )
    rules = [
        Rule("quantity", ({"greater_than": 2}, {"less_than_or_equal": 49})), Rule("discount", ({"less_than": 0.1},)),
        Rule("tax", ({"greater_than_or_equal": 0.01},)),
    ]
    return check_rows(text, rules).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", joined(REASONS).alias("reasons"))


def lineitem_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as two files by status; the position is the order of all columns."""
    place = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return landed(table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_linestatus").alias("file_path"),
        F.struct(*place).alias("_row_index"), money("l_extendedprice").cast("string").alias("price"),
    ))


@query(
    "dq_duplicates",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn FROM lineitem)
       SELECT l_linestatus AS file_path, l_orderkey, l_linenumber, l_partkey, l_suppkey,
              'duplicate business key: (l_orderkey=''' || l_orderkey || ''', l_linenumber=''' || l_linenumber || ''')' AS reasons
       FROM r WHERE rn > 1""",
)
def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    checked = check_rows(lineitem_feed(spark, folder), [], business_key=["l_orderkey", "l_linenumber"])
    return checked.filter(FAILED).select(
        "file_path", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", joined(REASONS).alias("reasons")
    )


@query(
    "dq_group_level",
    """WITH t AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal < -970 AS bad FROM customer),
       g AS (SELECT *, max(CAST(bad AS INT)) OVER (PARTITION BY c_nationkey, c_mktsegment) AS g FROM t)
       SELECT c_custkey, CASE WHEN bad THEN 'balance: greater_than_or_equal'
              WHEN g = 1 THEN 'quarantined with group (nation=''' || c_nationkey || ''', segment=''' || c_mktsegment
                || ''') - another row in this group failed DQ' ELSE '' END AS reasons FROM g""",
)
def dq_group_level(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"),
        money("c_acctbal").cast("string").alias("balance"), F.lit("customers").alias("file_path"),
    )
    rules = [Rule("balance", ("is_numeric", {"greater_than_or_equal": -970}))]
    checked = check_rows(text, rules, group_by=["nation", "segment"])
    return checked.select("c_custkey", joined(REASONS).alias("reasons"))


@query(
    "dq_duplicates_and_groups",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) > 1 AS dup FROM lineitem),
       g AS (SELECT *, max(CAST(dup AS INT)) OVER (PARTITION BY l_linestatus, l_orderkey) = 1 AS grp FROM r)
       SELECT l_linestatus AS file_path, l_orderkey, count(*) AS n_rows, CAST(sum(CAST(dup AS INT)) AS BIGINT) AS duplicates,
              CAST(sum(CASE WHEN grp AND NOT dup THEN 1 ELSE 0 END) AS BIGINT) AS swept FROM g GROUP BY 1, 2""",
)
def dq_duplicates_and_groups(spark: SparkSession, folder: str) -> DataFrame:
    feed = lineitem_feed(spark, folder)
    checked = check_rows(feed, [], business_key=["l_orderkey", "l_linenumber"], group_by=["l_orderkey"])
    reason = F.try_element_at(REASONS, F.lit(1))
    return checked.groupBy("file_path", "l_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.startswith(reason, F.lit("duplicate"))).alias("duplicates"),
        F.count_if(F.startswith(reason, F.lit("quarantined"))).alias("swept"),
    )


_STRICT = """WITH t AS (SELECT strftime(l_shipdate, '%Y-%m') AS file_path, l_extendedprice,
                 NOT (l_extendedprice <= 104500 AND l_quantity > 0) AS bad FROM lineitem),
             f AS (SELECT file_path, bool_or(bad) AS blocked FROM t GROUP BY file_path) """


def shipments_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return landed(table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("file_path"), F.lit("").alias("file_name"),
        money("l_extendedprice").cast("string").alias("price"), money("l_quantity").cast("string").alias("quantity"),
    ))


STRICT_RULES = [
    Rule("price", ({"less_than_or_equal": 104500},), "decimal", 18, 2), Rule("quantity", ({"greater_than": 0},)),
]


@query(
    "dq_strict",
    _STRICT + """SELECT t.file_path, count(*) AS promoted, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
                 FROM t JOIN f USING (file_path) WHERE NOT blocked GROUP BY t.file_path""",
)
def dq_strict(spark: SparkSession, folder: str) -> DataFrame:
    checked = landed(check_rows(shipments_by_month(spark, folder), STRICT_RULES))
    valid, _ = split_batch(checked, STRICT_RULES, "strict")
    return valid.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("promoted"), F.sum("price").cast("double").alias("price")
    )


@query("dq_blocked_files", _STRICT + "SELECT file_path, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS failing FROM t GROUP BY 1 HAVING bool_or(bad)")
def dq_blocked_files(spark: SparkSession, folder: str) -> DataFrame:
    blocked = blocked_files(check_rows(shipments_by_month(spark, folder), STRICT_RULES))
    return blocked.select("file_path", F.col("_dq_rows").alias("n_rows"), F.col("_dq_bad").alias("failing"))


@query(
    "dq_alerts_strict",
    _STRICT + """SELECT 'F' || file_path AS file_name, 'F' || file_path || ': entire file quarantined (strict integrity_mode) - '
                 || count(*) FILTER (WHERE bad) || ' row(s) failed DQ' AS message FROM t GROUP BY file_path HAVING bool_or(bad)""",
)
def dq_alerts_strict(spark: SparkSession, folder: str) -> DataFrame:
    checked = check_rows(shipments_by_month(spark, folder), STRICT_RULES)
    _, bad = split_batch(checked, STRICT_RULES, "strict")
    named = bad.withColumn("file_name", F.concat(F.lit("F"), "file_path"))
    return row_alerts(named, "strict").select("file_name", "message")


@query(
    "dq_alerts_rows",
    ORDERS_CHECKED + """SELECT o_orderkey AS row_index, 'orders.csv: row ' || o_orderkey || ' quarantined - ' || replace(reasons, ';', '; ') AS message
                        FROM c WHERE reasons <> ''""",
)
def dq_alerts_rows(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_batch(orders_checked(spark, folder), ORDER_RULES, "row_level")
    return row_alerts(bad.withColumn("file_name", F.lit("orders.csv")), "row_level").select("row_index", "message")


@query(
    "dq_lookup",
    """SELECT user_id, event_type, count(*) AS n_rows,
              count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 2000)) AS misses
       FROM events e GROUP BY 1, 2""",
)
def dq_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Users of events against customers in good standing; the reference's size decides how."""
    users = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", F.lit("events").alias("file_path")
    )
    good = table(spark, folder, "customer").filter("c_acctbal > 2000").select(F.col("c_custkey").cast("string").alias("code"))
    checked = check_rows(users, [Rule("user_id", lookup="customers")], lookups={"customers": (good, "code")})
    return checked.groupBy(F.col("user_id").cast("long").alias("user_id"), "event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(FAILED).alias("misses")
    )


@query(
    "dq_lookup_large",
    """SELECT o_orderkey, o_custkey, 'customer: sql_lookup' AS reasons FROM orders o
       WHERE NOT EXISTS (SELECT 1 FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
                         WHERE c.c_custkey = o.o_custkey AND n.n_regionkey < 4)""",
)
def dq_lookup_large(spark: SparkSession, folder: str) -> DataFrame:
    """A reference whose size is not known to be small: distinct values are tested first."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("customer"), F.lit("orders").alias("file_path")
    )
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    known = customers.join(nations.filter("n_regionkey < 4"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").join(
        table(spark, folder, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    checked = check_rows(rows, [Rule("customer", lookup="c")], lookups={"c": (known, "c_custkey")})
    return checked.filter(FAILED).select("o_orderkey", "o_custkey", joined(REASONS).alias("reasons"))


@query(
    "dq_summary",
    f"WITH t AS ({ORDERS_TEXT}), " + r"""
    s AS (SELECT 'customer' AS column_name, 'not_nullable' AS check_name, count(*) AS element_count, count(*) FILTER (WHERE customer IS NULL) AS missing_count, count(*) FILTER (WHERE customer IS NULL) AS unexpected_count FROM t
     UNION ALL SELECT 'customer', 'non_empty', count(*), count(*) FILTER (WHERE customer IS NULL), count(*) FILTER (WHERE customer = '') FROM t
     UNION ALL SELECT 'price', 'not_nullable', count(*), count(*) FILTER (WHERE price IS NULL), count(*) FILTER (WHERE price IS NULL) FROM t
     UNION ALL SELECT 'price', 'is_numeric', count(*), count(*) FILTER (WHERE price IS NULL), count(*) FILTER (WHERE NOT regexp_full_match(price, '-?[0-9]+\.?[0-9]*')) FROM t
     UNION ALL SELECT 'price', 'greater_than_or_equal', count(*), count(*) FILTER (WHERE price IS NULL),
                      count(*) FILTER (WHERE price IS NOT NULL AND NOT regexp_full_match(price, '[0-9]+\.?[0-9]*')) FROM t
     UNION ALL SELECT 'ordered_on', 'not_nullable', count(*), count(*) FILTER (WHERE ordered_on IS NULL), count(*) FILTER (WHERE ordered_on IS NULL) FROM t
     UNION ALL SELECT 'ordered_on', 'valid_date', count(*), count(*) FILTER (WHERE ordered_on IS NULL), count(*) FILTER (WHERE try_strptime(ordered_on, '%Y%m%d') IS NULL) FROM t)
    SELECT column_name, check_name, element_count, missing_count, unexpected_count,
           round(unexpected_count * 100.0 / element_count, 6)::DOUBLE AS unexpected_percent, unexpected_count = 0 AS success FROM s""",
)
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return validation_summary(orders_text(spark, folder), ORDER_RULES).select(
        "column_name", "check_name", "element_count", "missing_count", "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"), "success",
    )


@query(
    "dq_unexpected_sample",
    ORDERS_CHECKED + """, e AS (SELECT DISTINCT unnest(string_split(reasons, ';')) AS reason, price, ordered_on, customer FROM c WHERE reasons <> ''),
    v AS (SELECT DISTINCT reason, CASE WHEN reason LIKE 'price%' THEN price WHEN reason LIKE 'ordered_on%' THEN ordered_on ELSE customer END AS value FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY value NULLS FIRST) AS rn FROM v)
    SELECT reason, string_agg(coalesce(value, 'NULL'), ',' ORDER BY rn) AS sample_values FROM r WHERE rn <= 20 GROUP BY reason""",
)
def dq_unexpected_sample(spark: SparkSession, folder: str) -> DataFrame:
    shown = F.transform("sample_values", lambda v: F.coalesce(v, F.lit("NULL")))
    return unexpected_sample(orders_text(spark, folder), ORDER_RULES, n=20).select(
        F.concat_ws(": ", "column_name", "check_name").alias("reason"), F.array_join(shown, ",").alias("sample_values")
    )


@query(
    "dq_distinct_reasons",
    ORDERS_CHECKED + "SELECT DISTINCT priority, unnest(string_split(reasons, ';')) AS reason FROM c WHERE reasons <> ''",
)
def dq_distinct_reasons(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_batch(orders_checked(spark, folder), ORDER_RULES, "row_level")
    return distinct_reasons(bad, ["priority"])

