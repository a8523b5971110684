"""Lineage as tables: column edges of a feed, run events and the edges they imply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.checks import Rule

# inputs / outputs: dataset names. schema_fields: (dataset, column, type).
# column_lineage: (output, output_column, input, input_column, description).
EVENT = (
    "event_type string, event_time timestamp, run_id string, job string, inputs array<string>, outputs array<string>, "
    "schema_fields array<struct<dataset:string,column:string,type:string>>, "
    "column_lineage array<struct<output:string,output_column:string,input:string,input_column:string,description:string>>"
)


def _rule_rows(spark: SparkSession, rules: list[Rule], business_key: list[str]) -> DataFrame:
    """A feed's rules and key as rows; a key column has a place behind all rules and no rule of its own."""
    spelt = [[c if isinstance(c, str) else str(dict(c)) for c in r.checks] for r in rules]
    stated = [(i, r.column, True, r.cast_to, s, bool(r.lookup)) for i, (r, s) in enumerate(zip(rules, spelt))]
    keys = [(len(rules) + i, k, False, None, [], False) for i, k in enumerate(business_key)]
    return spark.createDataFrame(stated + keys, "place int, name string, stated boolean, kind string, tests array<string>, referenced boolean")


def raw_to_stage_edges(
    spark: SparkSession, rules: list[Rule], business_key: list[str], raw_table: str, stage_table: str
) -> DataFrame:
    """One edge per column of the rules, in their order, then per key column without one; of two rules the later one is shown."""
    # The wording of a transformation.
    parts = F.concat_ws(
        "; ",
        F.when(F.col("kind").isNotNull(), F.concat(F.lit("cast_to="), "kind")),
        F.when(F.size("tests") > 0, F.concat(F.lit("checks=["), F.array_join("tests", ", "), F.lit("]"))),
        F.when(F.col("referenced"), F.lit("sql lookup validation")),
    )
    wording = F.when(~F.col("stated"), "passthrough (no quality.rules entry)").when(parts == "", "passthrough").otherwise(parts)
    columns = _rule_rows(spark, rules, business_key).withColumn("wording", wording).groupBy("name").agg(
        F.min("place").alias("place"), F.max_by("wording", F.struct("stated", "place")).alias("wording")
    )
    return columns.orderBy("place").select(
        F.lit("raw").alias("source_layer"), F.lit(raw_table).alias("source_table"), F.col("name").alias("source_column"),
        F.lit("stage").alias("target_layer"), F.lit(stage_table).alias("target_table"), F.col("name").alias("target_column"),
        F.col("wording").alias("transformation"),
    )


def lineage_event(
    spark: SparkSession, event_type: str, at: str, run_id: str, job: str, *,
    inputs: list[str] | None = None, outputs: list[str] | None = None,
    schemas: dict[str, list[tuple[str, str]]] | None = None, edges: list[tuple[str, str, str, str, str | None]] | None = None,
) -> DataFrame:
    """One START / COMPLETE / FAIL event of ``job`` (``pipeline.step``)."""
    if event_type not in ("START", "COMPLETE", "FAIL"):
        raise ValueError(f"unknown event type {event_type!r}")
    fields = [(d, n, t) for d, cols in (schemas or {}).items() for n, t in cols]
    row = (event_type, at, run_id, job, inputs or [], outputs or [], fields, edges or [])
    schema = EVENT.replace("event_time timestamp", "event_time string")
    return spark.createDataFrame([row], schema).withColumn("event_time", F.col("event_time").cast("timestamp"))


def _completed(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "COMPLETE").select("run_id", "job").distinct()


def _datasets(events: DataFrame, side: str, name: str) -> DataFrame:
    """Distinct tables on one side of a step. Files are no tables: paths from a root, with a scheme or with an ending."""
    file = F.col(name).rlike(r"^/|^[A-Za-z][A-Za-z0-9+.-]*:/|/[^/]*\.[^/]+$")
    return events.select("run_id", "job", F.explode(side).alias(name)).filter(~file).distinct()


def edges_from_events(events: DataFrame) -> DataFrame:
    """Table edges of completed steps.

    Inputs and outputs of all events of a (run, job) count, whichever event carries
    them; nothing is emitted before COMPLETE or without both sides. Both sides are
    reduced to distinct names first, so the join yields exactly the edges.
    """
    done = _completed(events)
    inputs = _datasets(events, "inputs", "source_table").join(done, ["run_id", "job"], "left_semi")
    outputs = _datasets(events, "outputs", "target_table")
    return inputs.join(outputs, ["run_id", "job"], "inner").select("run_id", "job", "source_table", "target_table")


def column_edges_from_events(events: DataFrame) -> DataFrame:
    """Column edges of completed steps, each mapping once.

    ``function`` is the first description given for the output column.
    """
    mappings = events.select("run_id", "job", "event_time", F.explode("column_lineage").alias("m")).select(
        "run_id", "job", "event_time", "m.*"
    )
    keys = ["run_id", "job", "output", "output_column"]
    described = mappings.filter(F.col("description").isNotNull()).groupBy(*keys).agg(
        F.min(F.struct("event_time", "description"))["description"].alias("function")
    )
    once = mappings.select(*keys, "input", "input_column").distinct()
    edges = edges_from_events(events).select(
        "run_id", "job", F.col("source_table").alias("input"), F.col("target_table").alias("output")
    )
    return (
        once.join(edges, ["run_id", "job", "input", "output"], "left_semi")
        .join(described, keys, "left")
        .select(
            "run_id", "job", F.col("input").alias("source_table"), F.col("input_column").alias("source_column"),
            F.col("output").alias("target_table"), F.col("output_column").alias("target_column"), "function",
        )
    )


def dataset_columns(events: DataFrame) -> DataFrame:
    """Columns known for every table of a completed step, from schemas and mappings."""
    done = _completed(events)
    listed = events.select("run_id", "job", F.explode("schema_fields").alias("f")).select("run_id", "job", "f.*")
    mapped = events.select("run_id", "job", F.explode("column_lineage").alias("m"))
    mentioned = mapped.select(
        "run_id", "job",
        F.explode(
            F.array(
                F.struct(F.col("m.output").alias("dataset"), F.col("m.output_column").alias("column")),
                F.struct(F.col("m.input").alias("dataset"), F.col("m.input_column").alias("column")),
            )
        ).alias("f"),
    ).select("run_id", "job", "f.*", F.lit(None).cast("string").alias("type"))
    return (
        listed.unionByName(mentioned)
        .join(done, ["run_id", "job"], "left_semi")
        .groupBy("dataset", "column")
        .agg(F.max("type").alias("type"))
    )


def gold_dependents(builds: DataFrame, pipeline_name: str | None = None) -> DataFrame:
    """Gold builds per pipeline they depend on. ``builds``: build_name, target_table, depends_on."""
    pairs = builds.select("build_name", "target_table", F.explode("depends_on").alias("pipeline_name")).distinct()
    return pairs if pipeline_name is None else pairs.filter(F.col("pipeline_name") == pipeline_name)
