"""Layer tables (bronze / silver / gold), generic sinks and the report source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from alloy.sources.generate import BRONZE_COLUMNS, LAB_RULES

BRONZE_SCHEMA = StructType(
    [StructField("sample_id", LongType(), True)]
    + [
        StructField(c, IntegerType() if c == "concentration" else DoubleType(), True)
        for c in BRONZE_COLUMNS[1:]
    ]
)


def silver_schema(base: StructType, rules) -> StructType:
    return StructType(list(base.fields) + [StructField(r.name, IntegerType(), False) for r in rules])


SILVER_SCHEMA = silver_schema(BRONZE_SCHEMA, LAB_RULES)
MANIFEST_SCHEMA = StructType([StructField("run_id", StringType()), StructField("attempt", StringType())])
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")  # sinks that can replace one run's rows


class SchemaMismatch(ValueError):
    pass


def check_schema(actual: StructType, expected: StructType) -> None:
    """Fail on a missing column or a type drift; extra columns are allowed."""
    have = {f.name: f.dataType for f in actual.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    drift = [
        f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}"
        for f in expected.fields
        if f.name in have and have[f.name] != f.dataType
    ]
    if missing or drift:
        raise SchemaMismatch(f"missing={missing} drift={drift}")


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a layer and check it against ``schema`` (footer metadata only).

    The projection keeps the declared column order; column pruning and filter
    pushdown still reach the scan because the check adds no operator.
    """
    df = spark.read.format(fmt).load(path)
    if schema is None:
        return df
    check_schema(df.schema, schema)
    return df.select(*[f.name for f in schema.fields])


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partitions: int | None = None,
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
) -> int:
    """Write a layer and return its row count (counted during the write).

    ``partitions`` forces a round-robin file count as the original jobs do;
    left unset, files follow the upstream partitioning (after AQE coalescing)
    and no extra shuffle is added -- what scales to very large inputs.
    Overwriting replaces the whole layer whatever the session's partition
    overwrite mode is, so a partition that no longer occurs disappears.
    """
    if partitions:
        df = df.repartition(partitions)
    df, obs = observed(df)
    writer = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(path)
    return int(obs.get.get("rows", 0))


def write_sink(
    df: DataFrame,
    fmt: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
    run_id: str | Column | None = None,
    attempt: str | None = None,
    manifest: str | None = None,
) -> None:
    """Write to any Spark data source (parquet, json, jdbc, a document store ...).

    With ``run_id`` the rows are tagged with it; it may be a column, so one
    write can hold several runs. ``attempt`` (an increasing stamp, e.g. the
    UTC write time) is stored as a column, so that a reader can tell a re-run
    from new data. A file sink is partitioned by ``run_id`` and a re-run
    replaces its own partition. Other sinks (jdbc, a document store) cannot
    replace part of a table: there rows are always appended, ``attempt`` is
    required, and ``latest_attempts`` reads the valid ones.

    With ``manifest`` (a path) a write is all or nothing: rows are added under
    their (run, attempt), beside what readers see, and the attempt is listed
    in the manifest only after the last row is written. ``published`` reads
    listed attempts alone, so a write that dies half-way is never seen and
    the run's former attempt stays in force. File sinks are then partitioned
    by ``run_id`` and ``attempt``. Needs one run id and an attempt stamp.
    """
    if manifest is not None and (not isinstance(run_id, str) or attempt is None):
        raise ValueError("a published write needs one run id and an attempt stamp")
    by_partition = run_id is not None and fmt.lower() in FILE_FORMATS
    if run_id is not None and not by_partition and attempt is None:
        raise ValueError(f"a run written to a {fmt} sink needs an attempt stamp")
    writer_df = df
    if attempt is not None:
        writer_df = writer_df.withColumn("attempt", F.lit(attempt))
    if run_id is not None:
        writer_df = writer_df.withColumn("run_id", run_id if isinstance(run_id, Column) else F.lit(run_id))
    writer = writer_df.write.format(fmt).options(**dict(options or {}))
    if by_partition:
        writer = writer.partitionBy(*("run_id", "attempt")[: 1 + (manifest is not None)]).option("partitionOverwriteMode", "dynamic")
        mode = "overwrite"
    writer = writer.mode(mode)
    if path is None:
        writer.save()
    else:
        writer.save(path)
    if manifest is not None:
        spark = df.sparkSession
        entry = spark.createDataFrame([(run_id, attempt)], MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(manifest)


def published(spark: SparkSession, df: DataFrame, manifest: str) -> DataFrame:
    """The rows of each run's newest attempt among those listed in ``manifest``.

    ``df`` is the sink as read, with ``run_id`` and ``attempt``. The manifest
    has one short row per write; on a file sink both columns are partitions,
    so Spark can prune the folders that no listed attempt names.
    """
    listed = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
    newest = listed.groupBy("run_id").agg(F.max("attempt").alias("attempt"))
    return df.join(newest, ["run_id", "attempt"], "left_semi")


def latest_attempts(df: DataFrame) -> DataFrame:
    """The rows of each run's latest attempt in an append-only sink."""
    newest = df.groupBy("run_id").agg(F.max("attempt").alias("attempt"))
    return df.join(newest, ["run_id", "attempt"]).select(*df.columns)


def read_report(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The first stored report document (a dashboard's ``find()[0]``)."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    return df.limit(1)
