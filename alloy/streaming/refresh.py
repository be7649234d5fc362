"""Keep the class statistics current as new files land (Structured Streaming).

The stream state is ONE row of mergeable sums and counts (the same
conditional aggregates as the batch ``compare``), so state size does not grow
with the data. Each micro-batch's complete result is unpivoted and written to
one of two slots with dynamic partition overwrite: a replayed epoch after a
failure rewrites its own slot, older epochs are written over, and a restart from the checkpoint
continues from the committed offsets without double counting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alloy.operators.rules import Rule
from alloy.operators.stats import compare_aggregate_names, compare_aggregates, compare_finish


SLOTS = 2  # published epochs that are kept: readers use the newest while the next is written


def _write_slot(out: DataFrame, dst: str, epoch_id: int) -> None:
    """Write an epoch over the one ``SLOTS`` before it; a replayed epoch rewrites itself.

    Epoch 0 belongs to a new checkpoint: it replaces all that an earlier
    stream left, whose higher epochs would otherwise stay the newest.
    """
    out = out.withColumns({"epoch": F.lit(epoch_id).cast("bigint"), "slot": F.lit(epoch_id % SLOTS)})
    kind = "static" if epoch_id == 0 else "dynamic"
    out.write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy("slot").parquet(dst)


def _publish(out: DataFrame, dst: str, epoch_id: int) -> None:
    _write_slot(out.coalesce(1), dst, epoch_id)


def refresh(
    spark: SparkSession,
    src: str,
    schema: StructType,
    rules: Sequence[Rule],
    spec: Mapping[str, Sequence[str]],
    dst: str,
    checkpoint: str,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the refresh query; ``available_now`` drains what is there and stops."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(src)
    state = stream.agg(*compare_aggregates(stream, rules, spec))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        out = compare_finish(batch, rules, spec)
        _publish(out, dst, epoch_id)

    writer = (
        state.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def refresh_runs(
    spark: SparkSession,
    src: str,
    schema: StructType,
    rules: Sequence[Rule],
    spec: Mapping[str, Sequence[str]],
    dst: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Statistics over a run-keyed sink (``write_sink(..., run_id, attempt)``)
    that stay exact when a run is re-written.

    The state is a table beside the checkpoint (``run_state``) with one row of
    mergeable sums per run: its newest attempt's. A micro-batch is aggregated
    by (run_id, attempt) inside its scan tasks, so that a run holding most
    rows crosses the shuffle as one row per task, and merged with the state:
    rows of the same attempt add, a later attempt replaces the earlier one,
    rows of an earlier attempt that come late are left out. Old attempts are
    forgotten, however often a run is written. Each publication adds the runs
    up.

    An epoch reads the state of the epoch before it and writes the other slot,
    so a replayed epoch starts from the same state; a new checkpoint starts
    from none. A null ``run_id`` is a run of its own; a null ``attempt`` is
    earlier than any other. ``schema`` must include both columns.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(src)
    names = compare_aggregate_names(rules, spec)
    state = f"{checkpoint}/run_state"

    def publish(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        partial = batch.groupBy("run_id", "attempt").agg(*compare_aggregates(batch, rules, spec))
        types = dict(partial.dtypes)
        if epoch_id:
            known = run_state(session, checkpoint, epoch_id - 1).select(*partial.columns)
            sums = [F.sum(c).cast(types[c]).alias(c) for c in names]
            partial = partial.unionByName(known).groupBy("run_id", "attempt").agg(*sums)
        newest = F.max_by(F.struct("attempt", *names), F.struct("attempt")).alias("s")
        _write_slot(partial.groupBy("run_id").agg(newest).select("run_id", "s.*"), state, epoch_id)
        total = run_state(session, checkpoint, epoch_id).agg(*[F.sum(c).alias(c) for c in names])
        _publish(compare_finish(total, rules, spec), dst, epoch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_state(spark: SparkSession, checkpoint: str, epoch: int | None = None) -> DataFrame:
    """The state of ``refresh_runs`` after an epoch (the newest by default): one row
    (run_id, attempt, partial aggregates) per run."""
    path = f"{checkpoint}/run_state"
    if epoch is None:
        return latest(spark, path)
    stored = spark.read.parquet(path)
    return stored.filter((F.col("slot") == epoch % SLOTS) & (F.col("epoch") == epoch)).drop("epoch", "slot")


def latest(spark: SparkSession, dst: str) -> DataFrame:
    """The statistics of the most recent epoch (condition, flag, metric, n, mean)."""
    df = spark.read.parquet(dst)
    last = df.select(F.max("epoch")).scalar()
    return df.filter(F.col("epoch") == F.lit(last)).drop("epoch", "slot")
