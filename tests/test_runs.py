"""Runs written again and again: the stream's state per run, and writes that are all or nothing."""

import pytest
from pyspark.sql import functions as F

from alloy.operators import stats as S
from alloy.operators.rules import Rule
from alloy.plans import medallion
from alloy.sources.layers import published, write_sink
from alloy.sources.tables import read_table
from alloy.streaming.refresh import latest, refresh, refresh_runs, run_state
from sf_dirs import SF_SMALL

RULES = (Rule("low", "x", "<", 5.0, "Low"),)
SPEC = {"low": ("x", "y")}
ROWS = "run_id string, attempt string, x double, y double"


def _key(df):
    return sorted((r["condition"], r["flag"], r["metric"], r["n"], r["mean"]) for r in df.collect())


def _add(spark, path, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


def _drain(spark, root, checkpoint="ck", one_by_one=False):
    schema = spark.createDataFrame([], ROWS).schema
    refresh_runs(spark, f"{root}/in", schema, RULES, SPEC, dst=f"{root}/out", checkpoint=f"{root}/{checkpoint}",
                 max_files_per_trigger=1 if one_by_one else None).awaitTermination()


def _batch(spark, rows):
    return _key(S.compare(spark.createDataFrame(rows, ROWS), RULES, SPEC))


def test_state_holds_one_entry_per_run_after_ten_reruns(spark, tmp_dir):
    other = [("b", "01", 7.0, 1.0), (None, None, 2.0, 3.0)]
    _add(spark, f"{tmp_dir}/in", other)
    for i in range(10):
        newest = [("a", f"{i:02}", float(i), 2.0 * i), ("a", f"{i:02}", 9.0, None)]
        _add(spark, f"{tmp_dir}/in", newest)
        if i in (0, 4, 9):  # several attempts within one epoch, and one epoch after another
            _drain(spark, tmp_dir, one_by_one=i == 4)
    state = {r["run_id"]: r["attempt"] for r in run_state(spark, f"{tmp_dir}/ck").collect()}
    assert state == {"a": "09", "b": "01", None: None} and run_state(spark, f"{tmp_dir}/ck").count() == 3
    assert _key(latest(spark, f"{tmp_dir}/out")) == _batch(spark, other + newest)


def test_files_of_one_attempt_add_up_and_late_old_attempts_are_left_out(spark, tmp_dir):
    first, second = [("a", "02", 1.0, 1.0)], [("a", "02", 8.0, 4.0)]
    for rows in (first, [("a", "01", 3.0, 3.0)], second):
        _add(spark, f"{tmp_dir}/in", rows)
        _drain(spark, tmp_dir)
    assert _key(latest(spark, f"{tmp_dir}/out")) == _batch(spark, first + second)


def test_a_new_checkpoint_starts_anew_over_an_old_destination(spark, tmp_dir):
    for i in range(4):
        _add(spark, f"{tmp_dir}/in", [("a", f"{i}", float(i), 1.0)])
    _drain(spark, tmp_dir, one_by_one=True)
    _add(spark, f"{tmp_dir}/in", [("c", "0", 6.0, 6.0)])
    _drain(spark, tmp_dir, "second")
    want = _batch(spark, [("a", "3", 3.0, 1.0), ("c", "0", 6.0, 6.0)])
    assert _key(latest(spark, f"{tmp_dir}/out")) == want
    schema = spark.createDataFrame([], ROWS).schema
    refresh(spark, f"{tmp_dir}/in", schema, RULES, SPEC, f"{tmp_dir}/out", f"{tmp_dir}/third").awaitTermination()
    every = [("a", "", float(i), 1.0) for i in range(4)] + [("c", "", 6.0, 6.0)]
    assert _key(latest(spark, f"{tmp_dir}/out")) == _batch(spark, every)


def test_a_hot_run_crosses_the_shuffle_as_partial_rows(spark, tmp_dir):
    """The micro-batch is combined before its exchange, and only the state's rows follow."""
    rows = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 9)).alias("run_id"),
                                     F.lit("1").alias("attempt"), (F.col("id") % 11).cast("double").alias("x"), F.lit(1.0).alias("y"))
    plan = rows.groupBy("run_id", "attempt").agg(*S.compare_aggregates(rows, RULES, SPEC))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    rows.write.parquet(f"{tmp_dir}/in")
    _drain(spark, tmp_dir)
    assert run_state(spark, f"{tmp_dir}/ck").count() == rows.select("run_id").distinct().count()
    assert _key(latest(spark, f"{tmp_dir}/out")) == _key(S.compare(rows, RULES, SPEC))


def _seen(spark, root):
    sink = spark.read.schema("x long, run_id string, attempt string").parquet(f"{root}/rows")
    return sorted((r["run_id"], r["x"]) for r in published(spark, sink, f"{root}/manifest").collect())


def test_a_write_that_dies_is_never_seen(spark, tmp_dir):
    write = lambda df, run, attempt: write_sink(df, "parquet", f"{tmp_dir}/rows", run_id=run, attempt=attempt, manifest=f"{tmp_dir}/manifest")
    ids = spark.range(3).withColumnRenamed("id", "x")
    write(ids, "a", "1")
    write(ids.where("x = 0"), "b", "1")
    before = _seen(spark, tmp_dir)
    assert before == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    dying = spark.range(100, 200).select(F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="lost"):
        write(dying, "a", "2")
    part = ids.withColumns({"run_id": F.lit("a"), "attempt": F.lit("2")})  # what a sink without a commit keeps of it
    part.write.mode("append").partitionBy("run_id", "attempt").parquet(f"{tmp_dir}/rows")
    assert _seen(spark, tmp_dir) == before
    for _ in range(2):  # a retry of the attempt replaces what it left; repeated, it changes nothing
        write(ids.where("x = 2"), "a", "2")
        assert _seen(spark, tmp_dir) == [("a", 2), ("b", 0)]


def test_published_writes_need_one_run_and_an_attempt(spark, tmp_dir):
    df = spark.range(2).withColumn("run_id", F.lit("a"))
    for kw in (dict(run_id=F.col("run_id"), attempt="1"), dict(run_id="a"), dict(attempt="1")):
        with pytest.raises(ValueError):
            write_sink(df, "parquet", f"{tmp_dir}/rows", manifest=f"{tmp_dir}/manifest", **kw)


def test_chain_with_published_rows(spark, tmp_dir):
    keys = read_table(spark, SF_SMALL, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    paths = medallion.Paths(f"{tmp_dir}/chain")
    cfg = medallion.RunConfig(run_id="day-1", publish=True)
    for _ in range(2):
        medallion.run(spark, keys, "k", paths, cfg, stages=("extract", "transform", "load"))
    counts = {r["layer"]: r["n"] for r in medallion.layer_counts(spark, paths, cfg).collect()}
    assert counts["sink_rows"] == counts["silver"]
    assert spark.read.parquet(paths.rows_sink).count() == 2 * counts["silver"]
