"""JSON documents and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.sources.scan import Paths, file_columns, in_scan_order


def _all_text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _at_path(schema: T.StructType, record_path: str) -> T.DataType:
    node: T.DataType = schema
    for key in record_path.split("."):
        if not isinstance(node, T.StructType) or key not in node.fieldNames():
            raise ValueError(f"record_path {record_path!r} not found in the JSON documents")
        node = node[key].dataType
    return node


def read_json_records(
    spark: SparkSession,
    path: Paths,
    *,
    lines: bool = False,
    record_path: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Records of JSON files as text columns.

    A file holds one object, an array of objects or, with ``lines``, one object per
    line. ``record_path`` leads from the document to the record array. Scalars keep
    their source spelling, booleans are ``true`` / ``false``, nested values stay
    JSON text and NULL stays NULL. Naming the ``columns`` avoids the pass over the
    files that finds them.
    """
    reader = spark.read.option("multiLine", not lines)
    if record_path is None or lines:
        if columns is None:
            found = reader.option("primitivesAsString", True).json(path)
            columns = [f.name for f in found.schema.fields]
        scanned = reader.schema(_all_text(columns)).option("mode", "FAILFAST").json(path)
        return in_scan_order(scanned.select(*[col(c) for c in columns], *file_columns()))

    inferred = None
    if columns is None:
        inferred = reader.option("primitivesAsString", True).json(path).schema
    node: T.DataType = T.ArrayType(_all_text(columns)) if columns else _at_path(inferred, record_path)
    single = isinstance(node, T.StructType)
    element = node if single else node.elementType if isinstance(node, T.ArrayType) else None
    if not isinstance(element, T.StructType):
        raise ValueError(f"record_path {record_path!r} must lead to a list of objects")
    record = _all_text(element.fieldNames())

    wanted: T.DataType = record if single else T.ArrayType(record)
    keys = record_path.split(".")
    for key in reversed(keys):
        wanted = T.StructType([T.StructField(key, wanted)])
    scanned = reader.schema(wanted).option("mode", "FAILFAST").json(path)
    target = col(keys[0])
    for key in keys[1:]:
        target = target.getField(key)
    records = F.array(target) if single else target
    rows = scanned.select(F.explode(records).alias("__r"), *file_columns())
    fields = [F.col("__r").getField(n).alias(n) for n in record.fieldNames()]
    return in_scan_order(rows.select(*fields, "file_path", "file_name", "_block_start"))
