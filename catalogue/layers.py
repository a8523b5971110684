"""Silver write modes, merges and reference seeding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import money, query, table
from tierline.functions.spread import new_folder
from tierline.operators.bucket_table import BucketTable
from tierline.operators.export import export_table
from tierline.operators.stage import insert_missing, latest_per_key, merge_upsert, upsert_partitions, write_stage
from tierline.operators.tables import SnapshotTable

# Two deliveries of orders that overlap in 1997; the second one has new prices.
_DELIVERIES = """WITH target AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price
                                 FROM orders WHERE o_orderdate < '1998-01-01'),
     source AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS price
                FROM orders WHERE o_orderdate >= '1997-01-01') """


def deliveries(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders")
    key, day, price = F.col("o_orderkey"), F.to_date("o_orderdate").alias("day"), money("o_totalprice")
    target = orders.filter("o_orderdate < '1998-01-01'").select(key, day, price.alias("price"))
    source = orders.filter("o_orderdate >= '1997-01-01'").select(key, day, (price * 2).cast("decimal(18,2)").alias("price"))
    return target, source


def _shown(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "day", F.col("price").cast("double").alias("price"))


_UPSERTED = _DELIVERIES + """SELECT o_orderkey, day, CAST(price AS DOUBLE) AS price FROM source
    UNION ALL SELECT o_orderkey, day, CAST(price AS DOUBLE) FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)"""


@query("stage_upsert", _UPSERTED)
def stage_upsert(spark: SparkSession, folder: str) -> DataFrame:
    target, source = deliveries(spark, folder)
    return _shown(merge_upsert(target, source, ["o_orderkey"]))


@query("stage_upsert_table", _UPSERTED)
def stage_upsert_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a written table; repeating the upsert changes nothing."""
    target, source = deliveries(spark, folder)
    silver = SnapshotTable(spark, new_folder(spark, "silver"))
    write_stage(target, silver, "append")
    for _ in range(2):
        write_stage(source, silver, "upsert", key=["o_orderkey"])
    return _shown(silver.read())


@query("stage_upsert_partitions", _UPSERTED)
def stage_upsert_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a table partitioned by year, of which only touched years are rewritten."""
    out = new_folder(spark, "silver")
    for part in deliveries(spark, folder):
        upsert_partitions(part.withColumn("year", F.year("day")), out, ["o_orderkey", "year"], ["year"])
    return _shown(spark.read.parquet(out))


_CHANGED = """WITH source AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS price FROM orders WHERE o_orderkey % 100 = 7)
    SELECT o_orderkey, day, CAST(price AS DOUBLE) AS price FROM source
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) FROM orders WHERE o_orderkey % 100 <> 7"""


@query("stage_upsert_buckets", _CHANGED)
def stage_upsert_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """New prices of one order in a hundred; only the buckets of their keys are written, and repeating it changes nothing."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("price"))
    silver = BucketTable(spark, new_folder(spark, "silver"))
    silver.upsert(orders, ["o_orderkey"])
    changed = orders.filter("o_orderkey % 100 = 7").withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    for _ in range(2):
        write_stage(changed, silver, "upsert", key=["o_orderkey"])
    silver.drop_old(1)
    return _shown(silver.read())


@query("stage_append", _DELIVERIES + """SELECT day, count(*) AS n_rows, CAST(sum(price) AS DOUBLE) AS price
       FROM (SELECT * FROM target UNION ALL SELECT * FROM source) GROUP BY day""")
def stage_append(spark: SparkSession, folder: str) -> DataFrame:
    silver = SnapshotTable(spark, new_folder(spark, "silver"))
    for part in deliveries(spark, folder):
        write_stage(part, silver, "append")
    return silver.read().groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").cast("double").alias("price"))


@query("stage_truncate", _DELIVERIES + "SELECT o_orderkey, day, CAST(price AS DOUBLE) AS price FROM source")
def stage_truncate(spark: SparkSession, folder: str) -> DataFrame:
    silver = SnapshotTable(spark, new_folder(spark, "silver"))
    for part in deliveries(spark, folder):
        write_stage(part, silver, "truncate_load")
    return _shown(silver.read())


@query(
    "stage_latest_file_wins",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM r WHERE rn = 1""",
)
def stage_latest_file_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Many files of a batch carry the same key; the row of the latest file stays."""
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    return latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query("insert_missing", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def insert_missing_query(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "events").select(F.col("user_id").alias("c_custkey"))
    return insert_missing(known, table(spark, folder, "customer").select("c_custkey", "c_name"), ["c_custkey"])


@query("export_table", "SELECT o_orderstatus, 2 * count(*) AS n_rows FROM orders GROUP BY 1")
def export_table_query(spark: SparkSession, folder: str) -> DataFrame:
    """Created by the first export, appended to by the second."""
    out = new_folder(spark, "export")
    for _ in range(2):
        export_table(table(spark, folder, "orders"), "shop.orders", location=out)
    return spark.read.parquet(f"{out}/shop/orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
