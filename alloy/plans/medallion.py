"""The medallion chain: extract -> transform -> model -> load.

Stages communicate only through written layers in the shared folder, which
also cuts lineage: a lost executor in a later stage recomputes from the last
written layer, never from the generator or the dedup shuffle. The first
failing stage is logged and re-raised, so a scheduler's retry sees it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.operators import clean, model, rules as R, stats
from alloy.plans.audit import AuditLog
from alloy.plans.report import as_document, to_report
from alloy.sources.generate import BRONZE_COLUMNS, LAB_METRIC_LABELS, LAB_RULES, LAB_SPEC, measurements_for
from alloy.sources.layers import BRONZE_SCHEMA, published, read_layer, silver_schema, write_layer, write_sink

STAGES = ("extract", "transform", "model", "load")


@dataclass
class Paths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def registry(self) -> str:
        return f"{self.root}/model"

    @property
    def rows_sink(self) -> str:
        return f"{self.root}/sink/rows"

    @property
    def rows_manifest(self) -> str:
        return f"{self.root}/sink/rows_manifest"

    @property
    def report_sink(self) -> str:
        return f"{self.root}/sink/report"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"


REASON_CHARS = 500  # of a failed stage's error in the audit log


@dataclass
class RunConfig:
    run_id: str  # names the run in the sinks and the registry: a repeated one replaces its own rows
    rules: Sequence[R.Rule] = LAB_RULES
    spec: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(LAB_SPEC))
    partitions: int | None = None  # files per layer, and tasks of generation and scoring
    # "rows": repeated rows go, keys included; "measurements": equal measurements under any
    # key are one sample, which keeps its smallest key
    dedup: str = "rows"
    sink_format: str = "parquet"
    sink_options: Mapping[str, str] = field(default_factory=dict)
    # the row sink shows a run only when all of its rows are written; its former attempt until then
    publish: bool = False
    sink_path: str | None = None  # where the row sink lies; "" for sinks that options alone name
    report_format: str = "json"
    report_options: Mapping[str, str] = field(default_factory=dict)
    audit_format: str = "parquet"
    audit_options: Mapping[str, str] = field(default_factory=dict)
    max_train_rows: int = model.MAX_TRAIN_ROWS
    trees: int = 100
    depth: int = 6
    seed: int = 42
    train_pct: int = 70
    metric_labels: Mapping[str, str] = field(default_factory=lambda: dict(LAB_METRIC_LABELS))
    # "copy": gold rows written again, partitioned by condition (the original layout);
    # "view": silver written sorted by its flags within each task, gold read from it
    gold_mode: str = "copy"
    # sort order of the flags in view mode (rarest first skips the most); rule order when unset
    view_order: Sequence[str] | None = None


def extract(spark: SparkSession, keys: DataFrame, key: str, paths: Paths, cfg: RunConfig, log: AuditLog) -> int:
    """Generate bronze rows for every key of ``keys`` and write the layer.

    Generation is CPU-bound arithmetic: with ``cfg.partitions`` the keys are
    dealt over that many tasks first, else they stay in the splits they come in.
    """
    keys = keys.select(key)
    bronze = measurements_for(keys.repartition(cfg.partitions) if cfg.partitions else keys, key)
    n = write_layer(bronze, paths.bronze)
    log.info("extract", f"bronze rows written: {n}")
    return n


def transform(spark: SparkSession, paths: Paths, cfg: RunConfig, log: AuditLog) -> dict[str, int]:
    """bronze -> dedup -> drop incomplete -> flag -> silver; silver -> gold by condition.

    Gold is written in one pass partitioned by ``condition`` from the
    re-read silver layer (no cache, no per-condition jobs). With
    ``gold_mode="view"`` no gold copy is written; ``gold()`` reads each
    condition from silver, whose rows are sorted by flags within each file.
    """
    if cfg.gold_mode not in ("copy", "view"):
        raise ValueError(f"unknown gold_mode {cfg.gold_mode!r}")
    if cfg.dedup not in ("rows", "measurements"):
        raise ValueError(f"unknown dedup {cfg.dedup!r}")
    bronze = read_layer(spark, paths.bronze, BRONZE_SCHEMA)
    keys = BRONZE_COLUMNS[1:] if cfg.dedup == "measurements" else None
    silver = R.flag(clean.drop_incomplete(clean.dedup(bronze, keys=keys)), cfg.rules)
    if cfg.gold_mode == "view":
        # rows of equal flags share row groups, whose min/max statistics let a
        # flag filter skip the rest: gold needs no second copy
        silver = silver.sortWithinPartitions(*(cfg.view_order or [r.name for r in cfg.rules]))
    n_silver = write_layer(silver, paths.silver, partitions=cfg.partitions)
    log.info("transform", f"silver rows written: {n_silver}")
    if cfg.gold_mode == "view":
        return {"silver": n_silver, "gold": 0}
    gold = R.route_long(_silver(spark, paths, cfg), cfg.rules)
    n_gold = write_layer(gold, paths.gold, partition_by=["condition"])
    log.info("transform", f"gold rows written: {n_gold}")
    return {"silver": n_silver, "gold": n_gold}


def train_and_gate(spark: SparkSession, paths: Paths, cfg: RunConfig, log: AuditLog) -> DataFrame:
    silver = _silver(spark, paths, cfg)
    frame = R.all_pass_label(model.lab_features(silver), cfg.rules)
    train_df, test_df = model.hash_split(frame, ["sample_id"], cfg.train_pct)
    fitted = model.train(train_df, model.LAB_FEATURES, "label", cfg.trees, cfg.depth, cfg.seed, cfg.max_train_rows)
    result = model.gate(spark, fitted, paths.registry, test_df, cfg.run_id, partitions=cfg.partitions)
    row = result.first()
    log.info("model", ("promoted" if row["promoted"] else "kept champion") + f"; fit on at most {cfg.max_train_rows} rows")
    return result


def load(spark: SparkSession, paths: Paths, cfg: RunConfig, log: AuditLog) -> dict[str, int]:
    """Append silver rows to the row sink (keyed by run) and overwrite the report.

    One pass over silver serves both: the statistics are observed during the
    append instead of being computed by a second scan.
    """
    silver = _silver(spark, paths, cfg)
    # the append scans every silver row anyway: the statistics ride along on
    # that scan (shuffle-free, so each task's metrics merge exactly once)
    observed, statistics = stats.observe_compare(silver, cfg.rules, cfg.spec)
    attempt = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    sink = paths.rows_sink if cfg.sink_path is None else cfg.sink_path or None
    manifest = paths.rows_manifest if cfg.publish else None
    write_sink(observed, cfg.sink_format, sink, cfg.sink_options, run_id=cfg.run_id, attempt=attempt, manifest=manifest)
    long = statistics(spark)
    counts = stats.prevalence_from(long)
    report = as_document(to_report(long, counts, cfg.rules, cfg.metric_labels))
    write_sink(report, cfg.report_format, None if cfg.report_options else paths.report_sink, cfg.report_options, mode="overwrite")
    n_sections = len(cfg.rules) + 1
    log.info("load", f"report sections written: {n_sections}")
    return {"report_sections": n_sections}


def run(
    spark: SparkSession,
    keys: DataFrame,
    key: str,
    paths: Paths,
    cfg: RunConfig,
    stages: Sequence[str] = STAGES,
) -> dict[str, object]:
    """Run the chosen stages in order; flush the audit log after each stage,
    also on failure, then re-raise the first error."""
    log = AuditLog(spark, None if cfg.audit_options else paths.audit, cfg.audit_format, cfg.audit_options)
    log.ensure()
    out: dict[str, object] = {}
    steps: dict[str, Callable[[], object]] = {
        "extract": lambda: extract(spark, keys, key, paths, cfg, log),
        "transform": lambda: transform(spark, paths, cfg, log),
        "model": lambda: train_and_gate(spark, paths, cfg, log),
        "load": lambda: load(spark, paths, cfg, log),
    }
    for name in stages:
        try:
            out[name] = steps[name]()
        except Exception as e:
            log.error(name, f"{name} failed: {type(e).__name__}: {str(e)[:REASON_CHARS]}")
            log.flush()
            raise
        log.flush()
    return out


def _silver(spark: SparkSession, paths: Paths, cfg: RunConfig) -> DataFrame:
    return read_layer(spark, paths.silver, silver_schema(BRONZE_SCHEMA, cfg.rules))


def gold(spark: SparkSession, paths: Paths, rule: R.Rule, cfg: RunConfig) -> DataFrame:
    """The gold rows of one condition with the silver columns, in either layout:
    a partition-pruned read of the gold copy, or a flag-filtered read of silver."""
    if cfg.gold_mode == "view":
        return _silver(spark, paths, cfg).filter(F.col(rule.name) == 1)
    routed = spark.read.parquet(paths.gold).filter(F.col("condition") == rule.name)
    return routed.select(*[f.name for f in silver_schema(BRONZE_SCHEMA, cfg.rules).fields])


def layer_counts(spark: SparkSession, paths: Paths, cfg: RunConfig) -> DataFrame:
    """(layer, n) for bronze, silver and every gold condition, read back from storage."""
    def count_of(path: str, name: str) -> DataFrame:
        return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")

    if cfg.gold_mode == "view":
        gold = R.route_long(_silver(spark, paths, cfg), cfg.rules)
    else:
        gold = spark.read.parquet(paths.gold)
    gold = gold.groupBy("condition").agg(F.count(F.lit(1)).alias("n"))
    gold = gold.select(F.concat(F.lit("gold_"), F.col("condition")).alias("layer"), "n")
    sink = spark.read.parquet(paths.rows_sink)
    if cfg.publish:
        sink = published(spark, sink, paths.rows_manifest)
    sink_n = sink.agg(F.count(F.lit(1)).alias("n")).select(F.lit("sink_rows").alias("layer"), "n")
    return count_of(paths.bronze, "bronze").unionByName(count_of(paths.silver, "silver")).unionByName(gold).unionByName(sink_n)
