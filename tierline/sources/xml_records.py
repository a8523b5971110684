"""XML files, one row per record element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.functions.text import blank_to_null
from tierline.sources.scan import Paths, file_columns, in_scan_order

_ATTRIBUTE = "@"
_TEXT = "_VALUE"


def _last_present(value: Column, repeated: bool) -> Column:
    """A repeated element keeps its last value."""
    return F.element_at(F.filter(value, lambda v: v.isNotNull()), -1) if repeated else value


def _cells(value: Column, dtype: T.DataType, name: str, repeated: bool) -> list[tuple[str, Column]]:
    if isinstance(dtype, T.ArrayType):
        inner = F.flatten(value) if repeated else value
        return _cells(inner, dtype.elementType, name, True)
    if not isinstance(dtype, T.StructType):
        return [(name, blank_to_null(_last_present(value, repeated)))]
    has_children = any(not f.name.startswith(_ATTRIBUTE) and f.name != _TEXT for f in dtype.fields)
    cells: list[tuple[str, Column]] = []
    for field in dtype.fields:
        part = value.getField(field.name)
        if field.name.startswith(_ATTRIBUTE):
            label = f"{name}.{field.name}" if has_children else f"{name}{field.name}"
            cells.append((label, _last_present(part, repeated)))
        elif field.name == _TEXT:
            if not has_children:
                cells.append((name, blank_to_null(_last_present(part, repeated))))
        else:
            cells += _cells(part, field.dataType, f"{name}.{field.name}", repeated)
    return cells


def flatten_record(schema: T.StructType) -> list[tuple[str, Column]]:
    """Named text cells of a record: ``a.b`` for nesting, ``a@x`` for attributes."""
    cells: list[tuple[str, Column]] = []
    for field in schema.fields:
        if field.name.startswith(_ATTRIBUTE):
            cells.append((field.name, col(field.name)))
        elif field.name != _TEXT:
            cells += _cells(col(field.name), field.dataType, field.name, False)
    return cells


def read_xml_records(
    spark: SparkSession, path: Paths, record_xpath: str, *, schema: T.StructType | None = None
) -> DataFrame:
    """Record elements flattened to text columns.

    The last step of ``record_xpath`` names the record element. Passing the record
    ``schema`` avoids the pass over the files that finds it. No record element in
    any file gives an empty result.
    """
    tag = record_xpath.rsplit("/", 1)[-1]
    if not tag or tag in (".", "*"):
        raise ValueError(f"record_xpath {record_xpath!r} does not name a record element")
    reader = spark.read.format("xml").options(
        rowTag=tag, attributePrefix=_ATTRIBUTE, valueTag=_TEXT, inferSchema=False, ignoreSurroundingSpaces=False,
    )
    if schema is not None:
        reader = reader.schema(schema)
    records = reader.load(path)
    cells = flatten_record(records.schema)
    return in_scan_order(records.select(*[c.alias(n) for n, c in cells], *file_columns()))
