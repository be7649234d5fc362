"""Statistics maintained over runs: mergeable partial aggregates per (run, attempt).

A run's rows are scanned once, when the run is written. Its summary is one row
of sums and counts (``compare_aggregates``); a report over any set of runs adds
up the summaries of their latest attempts and never reads rows again. A run
that is written anew appends a summary of a later attempt, which replaces the
earlier one in every later report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.operators.rules import Rule
from alloy.operators.stats import compare_aggregate_names, compare_aggregates, compare_finish

Spec = Mapping[str, Sequence[str]]


def summarise(rows: DataFrame, rules: Sequence[Rule], spec: Spec, attempt: str, run: str = "run_id") -> DataFrame:
    """One row per run of ``rows``: (run_id, attempt, partial aggregates). A null run is a run of its own.

    Combined inside each scan task, so that a run holding most rows crosses
    the shuffle as one row per task. An empty table gives no summary.
    """
    partial = rows.groupBy(F.col(run).alias("run_id")).agg(*compare_aggregates(rows, rules, spec))
    return partial.withColumn("attempt", F.lit(attempt))


def append_summaries(summaries: DataFrame, path: str) -> None:
    """Add summaries to the stored table; a repeated append of one attempt changes no report."""
    summaries.write.mode("append").parquet(path)


def fold(spark: SparkSession, path: str, rules: Sequence[Rule], spec: Spec, runs: Sequence[str] | None = None) -> DataFrame:
    """The ``compare`` frame over the latest attempt of the chosen runs (all of them by default).

    Reads one small row per run and attempt. Runs that were never summarised
    add nothing; without any run the classes have n = 0 and null means.
    """
    stored = spark.read.parquet(path)
    if runs is not None:
        stored = stored.where(F.col("run_id").isin(list(runs)))
    names = compare_aggregate_names(rules, spec)
    newest = stored.groupBy("run_id").agg(F.max_by(F.struct(*names), "attempt").alias("s"))
    zero = lambda c: F.coalesce(F.sum(f"s.{c}"), F.lit(0)).alias(c) if c.startswith(("n_", "c_")) else F.sum(f"s.{c}").alias(c)
    return compare_finish(newest.agg(*(zero(c) for c in names)), rules, spec)
