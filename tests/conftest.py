import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="tierline-tests-"))
    yield session
    session.stop()


@pytest.fixture
def house(spark, tmp_path):
    from tierline.plans.ingest import Warehouse

    return Warehouse(spark, f"file:{tmp_path}/house")


@pytest.fixture
def rows_of():
    """Rows of a DataFrame as sorted plain tuples."""

    def collect(df, *columns):
        chosen = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple(("" if v is None else str(v)) for v in t))

    return collect
