"""Registered queries over the supplied tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables. Computed columns carry the same alias in the Spark plan and in
the oracle SQL; means and other non-exact doubles are rounded to 6 places on
both sides so the comparison does not depend on summation order.

``lineitem`` stands in for the sample table: its four threshold rules and
metric lists live in ``alloy.sources.tables``. The laboratory queries build
their bronze rows from lineitem's keys (``l_orderkey * 8 + l_linenumber``), so
their work grows with the table and repeated keys become duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from alloy.functions.columns import dated_title, interaction, mean_of, product_of_complements, ratio, share_of
from alloy.operators import clean as C
from alloy.operators import model as M
from alloy.operators import rules as R
from alloy.operators import stats as S
from alloy.operators.summaries import append_summaries, fold, summarise
from alloy.plans import medallion
from alloy.plans.audit import AuditLog
from alloy.plans.dashboard import section_available
from alloy.plans.report import REPORT_TYPE, as_document, from_report, to_report, to_typed_report, typed_cells
from alloy.session import scratch_path
from alloy.sources.generate import LAB_LABEL_STYLES, LAB_RULES, LAB_SPEC, measurement_sql, measurements_for
from alloy.sources.layers import published, read_report, write_layer, write_sink
from alloy.sources.tables import (
    LINEITEM_LABEL_STYLES,
    LINEITEM_METRICS,
    LINEITEM_RULES,
    LINEITEM_SPEC,
    read_table,
    table_path,
)
from alloy.sources.uniform import measurements_uniform_for, uniform_sql
from alloy.streaming.refresh import latest, refresh, run_state

Query = Callable[[SparkSession, str], DataFrame]
KEY = ("l_orderkey", "l_linenumber")
SAMPLE_KEY_SQL = "l_orderkey * 8 + l_linenumber"
DEDUP_ORDER = ("l_shipdate",)


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _lab_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir)
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sample_id"))


def _inject_gaps(li: DataFrame) -> DataFrame:
    """Nulls and NaN placed by key arithmetic (the tables have none)."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return li.withColumns(
        {
            "l_quantity": F.when(F.pmod(k, F.lit(7)) == 3, F.lit(None)).otherwise(F.col("l_quantity")),
            "l_discount": F.when(F.pmod(k + ln, F.lit(11)) == 5, F.lit(float("nan"))).otherwise(F.col("l_discount")),
            "l_tax": F.when(F.pmod(k * 3 + ln, F.lit(17)) == 2, F.lit(float("nan")))
            .when(F.pmod(k * 3 + ln, F.lit(17)) == 9, F.lit(None))
            .otherwise(F.col("l_tax")),
            "l_returnflag": F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None)).otherwise(F.col("l_returnflag")),
        }
    )


def lineitem_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_ratio": ratio("l_extendedprice", "l_quantity"),
            "disc_tax_interaction": interaction("l_discount", "l_tax"),
            "rate_mean": mean_of(["l_discount", "l_tax", "l_quantity"]),
        }
    )


LINEITEM_FEATURES = (
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "price_ratio",
    "disc_tax_interaction",
    "rate_mean",
)

# rule-based classifier used to exercise the evaluation: the first two rules only
PARTIAL_RULES = LINEITEM_RULES[:2]


def _rule_predictions(li: DataFrame) -> DataFrame:
    labelled = R.all_pass_label(li, LINEITEM_RULES)
    pred = F.when(R.all_pass(PARTIAL_RULES), F.lit(1.0)).otherwise(F.lit(0.0))
    return labelled.withColumn("prediction", pred)


def _split_bucket() -> F.Column:
    return F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber"), F.lit(10))


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------


def q_synthetic_bronze(spark, sf_dir):
    return measurements_for(_lab_keys(spark, sf_dir), "sample_id")


def q_synthetic_flags(spark, sf_dir):
    bronze = measurements_for(_lab_keys(spark, sf_dir), "sample_id")
    flagged = R.all_pass_label(R.flag(bronze, LAB_RULES), LAB_RULES)
    return flagged.select("sample_id", *[r.name for r in LAB_RULES], "label")


def _lab_silver(spark, sf_dir) -> DataFrame:
    """bronze (from lineitem keys) -> whole-row dedup -> drop incomplete -> flags."""
    bronze = measurements_for(_lab_keys(spark, sf_dir), "sample_id")
    return R.flag(C.drop_incomplete(C.dedup(bronze)), LAB_RULES)


def q_lab_compare_long(spark, sf_dir):
    return _r6(S.compare(_lab_silver(spark, sf_dir), LAB_RULES, LAB_SPEC), "mean")


def q_lab_prevalence(spark, sf_dir):
    prev = S.share(S.prevalence(_lab_silver(spark, sf_dir), LAB_RULES))
    return _r6(prev, "rate")


def q_lab_pivot_labels(spark, sf_dir):
    pivot = S.compare_pivot(S.compare(_lab_silver(spark, sf_dir), LAB_RULES, LAB_SPEC))
    out = S.display_labels(pivot, LAB_LABEL_STYLES)
    return _r6(out, "without", "with")


def q_lab_features(spark, sf_dir):
    silver = _lab_silver(spark, sf_dir)
    out = R.all_pass_label(M.lab_features(silver), LAB_RULES)
    derived = ["total_motility", "motility_ratio", "motility_vitality_interaction", "defect_ratio", "health_index"]
    return _r6(out.select("sample_id", *derived, "label"), *derived)


def q_rounding_modes(spark, sf_dir):
    x = F.col("l_quantity") / F.lit(4.0)
    return _lineitem(spark, sf_dir).select(
        *KEY,
        x.alias("x"),
        F.round(x, 1).alias("half_up"),
        F.bround(x, 1).alias("half_even"),
    )


def q_dedup_rows(spark, sf_dir):
    return C.dedup(_lineitem(spark, sf_dir).select("l_quantity", "l_discount", "l_tax"))


def q_dedup_by_key(spark, sf_dir):
    return C.dedup(_lineitem(spark, sf_dir), keys=KEY, order=DEDUP_ORDER)


def q_dropna_any(spark, sf_dir):
    return C.drop_incomplete(_inject_gaps(_lineitem(spark, sf_dir)))


def q_flag_rules(spark, sf_dir):
    flagged = R.flag(_lineitem(spark, sf_dir), LINEITEM_RULES)
    return flagged.select(*KEY, *[r.name for r in LINEITEM_RULES])


def q_all_pass_label(spark, sf_dir):
    return R.all_pass_label(_lineitem(spark, sf_dir), LINEITEM_RULES).select(*KEY, "label")


def q_label_flag_identity(spark, sf_dir):
    df = R.all_pass_label(R.flag(_lineitem(spark, sf_dir), LINEITEM_RULES), LINEITEM_RULES)
    total = sum((F.col(r.name) for r in LINEITEM_RULES[1:]), F.col(LINEITEM_RULES[0].name))
    broken = (F.col("label") == 1) != (total == 0)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(broken).alias("violations"))


def q_route_conditions(spark, sf_dir):
    return R.route_long(_lineitem(spark, sf_dir).select(*KEY, *LINEITEM_METRICS), LINEITEM_RULES).select(*KEY, "condition")



def q_route_counts(spark, sf_dir):
    routed = R.route_long(_lineitem(spark, sf_dir), LINEITEM_RULES)
    return routed.groupBy("condition").agg(F.count(F.lit(1)).alias("n"))


def q_compare_one(spark, sf_dir):
    rule = LINEITEM_RULES[0]
    out = S.compare_grouped(_lineitem(spark, sf_dir), rule, LINEITEM_SPEC[rule.name])
    return _r6(out, *[f"avg_{m}" for m in LINEITEM_SPEC[rule.name]])


def q_compare_long(spark, sf_dir):
    return _r6(S.compare(_lineitem(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC), "mean")


def _pivot(spark, sf_dir):
    return S.compare_pivot(S.compare(_lineitem(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC))


def q_compare_pivot(spark, sf_dir):
    return _r6(_pivot(spark, sf_dir), "without", "with")


def q_prevalence(spark, sf_dir):
    return _r6(S.prevalence(_lineitem(spark, sf_dir), LINEITEM_RULES), "rate")


def q_share_of_total(spark, sf_dir):
    return S.share(S.prevalence(_lineitem(spark, sf_dir), LINEITEM_RULES)).select("condition", "n", "pct")


def q_axis_max(spark, sf_dir):
    return _r6(S.axis_max(_pivot(spark, sf_dir)), "max")


def q_labels_display(spark, sf_dir):
    out = S.display_labels(_pivot(spark, sf_dir), LINEITEM_LABEL_STYLES)
    return out.select("condition", "metric", "without_label", "with_label")


def q_features(spark, sf_dir):
    out = lineitem_features(_lineitem(spark, sf_dir))
    return _r6(out.select(*KEY, "price_ratio", "disc_tax_interaction", "rate_mean"),
               "price_ratio", "disc_tax_interaction", "rate_mean")


def q_hash_split(spark, sf_dir):
    # both sides counted in one scan: the side label is the split's own cut
    side = M.split_side(_split_bucket(), train_pct=70, buckets=10)
    return _lineitem(spark, sf_dir).groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def q_scale_unit_std(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    vec = VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol="v").transform(li)
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=False, withStd=True).fit(vec)
    arr = vector_to_array(F.col("s"))
    out = scaler.transform(vec).select(*KEY, arr[0].alias("quantity_scaled"), arr[1].alias("price_scaled"))
    return _r6(out, "quantity_scaled", "price_scaled")


def q_confusion_matrix(spark, sf_dir):
    pred = _rule_predictions(_lineitem(spark, sf_dir))
    return pred.groupBy(F.col("label").alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_confusion_f1(spark, sf_dir):
    ev = M.evaluate(_rule_predictions(_lineitem(spark, sf_dir)))
    return ev.withColumns({"f1": F.round("f1", 9), "accuracy": F.round("accuracy", 9)})


def q_evaluator_f1(spark, sf_dir):
    f1, acc = M.evaluate_mllib(_rule_predictions(_lineitem(spark, sf_dir)))
    schema = StructType([StructField("f1", DoubleType()), StructField("accuracy", DoubleType())])
    return spark.createDataFrame([(round(f1, 9), round(acc, 9))], schema)


def _report(spark, sf_dir) -> DataFrame:
    li = _lineitem(spark, sf_dir)
    long = S.compare(li, LINEITEM_RULES, LINEITEM_SPEC)
    return to_report(long, S.prevalence_from(long), LINEITEM_RULES)


def q_report_document(spark, sf_dir):
    """The dated document: whether its title has the day's form, and its sections in order."""
    doc = _report(spark, sf_dir).withColumn("title", dated_title("Statistics report"))
    return doc.select(
        F.col("title").rlike(r"^Statistics report [0-3]\d-[01]\d-\d{4}$").alias("titled"), F.json_object_keys("report").alias("sections")
    )


def q_report_json(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_sink(as_document(_report(spark, sf_dir)), "json", path, mode="overwrite")
    stored = read_report(spark, "json", path, schema=as_document_schema())
    return _r6(from_report(stored), "value")


def q_report_section(spark, sf_dir):
    from alloy.plans.report import report_section

    return _r6(report_section(_report(spark, sf_dir), f"{LINEITEM_RULES[0].name}_Analysis"), "value")


GOLD_READ = ("low_qty", "low_tax")


def q_gold_partition_read(spark, sf_dir):
    """Routed rows written once partitioned by condition, then two conditions
    read back: the filter becomes a partition filter (no other folder is listed
    or scanned)."""
    path = scratch_path(spark, "gold")
    li = _lineitem(spark, sf_dir).select(*KEY, *LINEITEM_METRICS)
    write_layer(R.route_long(li, LINEITEM_RULES), path, partition_by=["condition"])
    gold = spark.read.parquet(path).filter(F.col("condition").isin(*GOLD_READ))
    out = gold.groupBy("condition").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"), F.max("l_orderkey").alias("max_orderkey")
    )
    return out


def q_dashboard_bars(spark, sf_dir):
    """Bar-chart frame rebuilt from the stored report, as the dashboard reads it."""
    from alloy.plans.dashboard import dashboard

    path = scratch_path(spark, "dashboard")
    write_sink(as_document(_report(spark, sf_dir)), "json", path, mode="overwrite")
    doc = read_report(spark, "json", path, schema=as_document_schema())
    bars = dashboard(doc, LINEITEM_RULES, LINEITEM_LABEL_STYLES)["bars"]
    return _r6(bars, "without", "with")


def _refreshed_runs(spark, sf_dir) -> str:
    """Run-keyed sink holding one run per return flag, written in one pass and
    streamed; the smallest flag's run is then written again (a re-run) and
    streamed from the same checkpoint. The run-aware statistics must still
    equal the batch statistics (a file-counting stream would count that run
    twice)."""
    from alloy.streaming.refresh import refresh_runs

    root = scratch_path(spark, "refresh-runs")
    li = _lineitem(spark, sf_dir).select(*KEY, *LINEITEM_METRICS, "l_returnflag")
    run_of = F.concat(F.lit("flag-"), F.col("l_returnflag"))
    write_sink(li.withColumn("run_id", run_of).drop("l_returnflag"), "parquet", f"{root}/sink",
               run_id=F.col("run_id"), attempt="0001-a")
    schema = spark.read.parquet(f"{root}/sink").schema

    def drain() -> None:  # one availableNow pass from the shared checkpoint
        refresh_runs(spark, f"{root}/sink", schema, LINEITEM_RULES, LINEITEM_SPEC,
                     dst=f"{root}/out", checkpoint=f"{root}/checkpoint").awaitTermination()

    drain()
    first = li.filter(F.col("l_returnflag") == li.select(F.min("l_returnflag")).scalar())
    write_sink(first.withColumn("run_id", run_of).drop("l_returnflag"), "parquet", f"{root}/sink",
               run_id=F.col("run_id"), attempt="0002-b")
    drain()  # the re-run's files are new to the stream; its earlier attempt must drop out
    return root


def q_refresh_runs_metrics(spark, sf_dir):
    return _r6(latest(spark, f"{_refreshed_runs(spark, sf_dir)}/out"), "mean")


def q_refresh_runs_state(spark, sf_dir):
    """What the run-aware stream remembers: one entry per run, of its newest attempt, with all its rows."""
    state = run_state(spark, f"{_refreshed_runs(spark, sf_dir)}/checkpoint")
    first = LINEITEM_RULES[0]
    metric = LINEITEM_SPEC[first.name][0]
    long = S.compare_finish(state, LINEITEM_RULES, LINEITEM_SPEC, ["run_id", "attempt"])
    one = long.filter((F.col("condition") == first.name) & (F.col("metric") == metric))
    return one.groupBy("run_id").agg(
        F.max("attempt").alias("attempt"), F.sum("n").cast("bigint").alias("n"), F.count_if(F.col("flag") == 0).alias("entries")
    )


def q_sink_published(spark, sf_dir):
    """Statistics over a sink that shows whole attempts only.

    Two runs are published; a second attempt of the first dies after half of
    its rows (added twice, to be told from the first) and is not listed; the
    other run is published again.
    """
    root = scratch_path(spark, "published")
    sink, manifest = f"{root}/rows", f"{root}/manifest"
    li = _lineitem(spark, sf_dir).select(*KEY, *LINEITEM_METRICS)
    even, odd = li.filter("l_orderkey % 2 = 0"), li.filter("l_orderkey % 2 = 1")
    write_sink(even, "parquet", sink, run_id="even", attempt="0001", manifest=manifest)
    write_sink(odd.unionAll(odd), "parquet", sink, run_id="odd", attempt="0001", manifest=manifest)
    half = even.filter("l_orderkey % 4 = 0")
    dying = half.unionAll(half).withColumns({"run_id": F.lit("even"), "attempt": F.lit("0002")})
    dying.write.mode("append").partitionBy("run_id", "attempt").parquet(sink)
    write_sink(odd, "parquet", sink, run_id="odd", attempt="0002", manifest=manifest)
    rows = published(spark, spark.read.schema(li.schema.add("run_id", "string").add("attempt", "string")).parquet(sink), manifest)
    return _r6(S.compare(rows, LINEITEM_RULES, LINEITEM_SPEC), "mean")


def as_document_schema() -> StructType:
    return StructType([StructField("report", REPORT_TYPE)])


def q_rf_gate(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    frame = R.all_pass_label(lineitem_features(li), LINEITEM_RULES)
    train, test = M.hash_split(frame, train_pct=70, buckets=10, bucket=_split_bucket())
    registry = scratch_path(spark, "registry")
    fitted = M.train(train, LINEITEM_FEATURES, "label", trees=100, depth=6, seed=42)
    # gate twice: the first run promotes (no champion), the second run offers
    # an identical challenger, whose tie keeps the champion
    results = [M.gate(spark, fitted, registry, test, f"attempt-{attempt}") for attempt in (1, 2)]
    out = results[0].unionByName(results[1])
    same = (F.col("challenger_f1") == F.col("champion_f1")) & (F.col("challenger_accuracy") == F.col("champion_accuracy"))
    return out.select(
        "run_id", "promoted", F.col("champion_f1").isNotNull().alias("had_champion"),
        F.coalesce(same, F.lit(False)).alias("scores_equal"), "n_test",
    )


CHAIN = medallion.RunConfig(run_id="run-1")


def _run_chain(spark, sf_dir, stages=("extract", "transform", "load")):
    paths = medallion.Paths(scratch_path(spark, "medallion"))
    medallion.run(spark, _lab_keys(spark, sf_dir), "sample_id", paths, CHAIN, stages)
    return paths


def q_medallion_run(spark, sf_dir):
    paths = _run_chain(spark, sf_dir)
    return medallion.layer_counts(spark, paths, CHAIN)


def _runs_of(spark, sf_dir):
    keys = _lab_keys(spark, sf_dir)
    return (("day-1", keys.filter("sample_id % 2 = 0")), ("day-2", keys.filter("sample_id % 2 = 1")))


def q_medallion_rerun(spark, sf_dir):
    """Two runs of different keys, then the first again under its own id: the
    layers hold the last run, the sink holds each run once."""
    paths = medallion.Paths(scratch_path(spark, "rerun"))
    days = _runs_of(spark, sf_dir)
    for run_id, keys in (*days, days[0]):
        cfg = medallion.RunConfig(run_id=run_id)
        medallion.run(spark, keys, "sample_id", paths, cfg, ("extract", "transform", "load"))
    runs = spark.read.parquet(paths.rows_sink).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    layers = medallion.layer_counts(spark, paths, medallion.RunConfig(run_id="day-1"))
    return layers.unionByName(runs.select(F.concat(F.lit("sink_"), F.col("run_id")).alias("layer"), "n"))


MORE_RULES = (*LAB_RULES, R.Rule("acid", "ph", "<", 7.2))


def q_medallion_custom_rules(spark, sf_dir):
    """The chain with three and with six rules: rows per flag in the sink."""
    out = None
    for rules in (LAB_RULES[:3], MORE_RULES):
        paths = medallion.Paths(scratch_path(spark, "rules"))
        cfg = medallion.RunConfig(run_id="run-1", rules=rules, spec={r.name: ("ph",) for r in rules})
        medallion.run(spark, _lab_keys(spark, sf_dir), "sample_id", paths, cfg, ("extract", "transform", "load"))
        flags = F.inline(F.array(*(F.struct(F.lit(r.name).alias("flag"), F.col(r.name).alias("hit")) for r in rules)))
        counts = spark.read.parquet(paths.rows_sink).select(flags).groupBy("flag").agg(F.sum("hit").cast("bigint").alias("n"))
        counts = counts.withColumn("n_rules", F.lit(len(rules)))
        out = counts if out is None else out.unionByName(counts)
    return out


def q_dedup_measurements(spark, sf_dir):
    """Samples that agree in all measurements under different keys are one sample, which keeps its smallest key."""
    bronze = measurements_for(_lab_keys(spark, sf_dir), "sample_id").select("sample_id", *COARSE)
    return C.dedup(bronze, keys=[c for c in bronze.columns if c != "sample_id"])


COARSE = ("volume_ml", "ph", "concentration")


def q_section_available(spark, sf_dir):
    """Which sections a stored report offers: those present, and one that is not."""
    doc = as_document(_report(spark, sf_dir))
    wanted = [f"{r.name}_Analysis" for r in LINEITEM_RULES] + ["Diseases_Count", "Absent_Analysis"]
    asked = [F.struct(F.lit(w).alias("section"), section_available(doc, w).alias("available")) for w in wanted]
    return doc.select(F.inline(F.array(*asked)))


def q_audit_log(spark, sf_dir):
    from alloy.plans.audit import AuditLog

    paths = _run_chain(spark, sf_dir)
    return AuditLog(spark, paths.audit).read().select("level", "source", "message")


def q_refresh_metrics(spark, sf_dir):
    root = scratch_path(spark, "refresh")
    schema = spark.read.parquet(table_path(sf_dir, "lineitem")).schema
    q = refresh(
        spark, sf_dir, schema, LINEITEM_RULES, LINEITEM_SPEC,
        dst=f"{root}/out", checkpoint=f"{root}/checkpoint", glob="lineitem.parquet",
    )
    q.awaitTermination()
    return _r6(latest(spark, f"{root}/out"), "mean")


SECOND_SEED = 20_240_607


def q_uniform_bronze(spark, sf_dir):
    """The original's uniform distributions over lineitem's keys."""
    return measurements_uniform_for(_lab_keys(spark, sf_dir))


def q_uniform_bronze_seeded(spark, sf_dir):
    """Another seed, and keys up to both ends of a bigint: a product beyond them goes on at the other end."""
    return measurements_uniform_for(_lab_keys(spark, sf_dir).select(_wide_key("sample_id").alias("sample_id")), seed=SECOND_SEED)


def _wide_key(key: str) -> F.Column:
    """15e12 times ``key``, negated for even keys, in 64-bit arithmetic that wraps instead of raising an error.

    15e12 is 3,662,109,375 * 2**12, so the low 52 bits of the key decide; they
    are multiplied in two halves, and the shift drops what is beyond 64 bits.
    """
    factor, half, low = 3_662_109_375, F.lit((1 << 26) - 1), F.lit((1 << 52) - 1)
    bits = F.col(key).cast("bigint").bitwiseAND(low)
    bits = F.when(F.col(key) % 2 == 0, (F.lit(1 << 52) - bits).bitwiseAND(low)).otherwise(bits)
    upper = F.shiftleft((F.shiftright(bits, 26) * F.lit(factor)).bitwiseAND(half), 26)
    return F.shiftleft(upper + bits.bitwiseAND(half) * F.lit(factor), 12)


def q_uniform_identities(spark, sf_dir):
    """Rows whose shares or normal forms do not follow from the other columns."""
    df = measurements_uniform_for(_lab_keys(spark, sf_dir))
    parts = ["motility_progressive", "motility_non_progressive", "motility_immotile"]
    off_share = F.greatest(*(F.abs(share_of(p, parts) - F.col(p)) for p in parts)) > 0.1001
    off_normal = F.abs(product_of_complements(["head_defects", "midpiece_defects", "tail_defects"]) - F.col("normal_forms")) > 0.0501
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(off_share | off_normal).alias("violations"))


ODD_RULES = tuple(R.Rule(r.name, r.column, r.op, r.threshold, label) for r, label in zip(
    LINEITEM_RULES, ('Low "quantity"', "Low\nprice", "Low \\ discount", "Niedrige Süße")))


def q_report_typed(spark, sf_dir):
    """The typed report stored as JSON text and read back: labels with quotes, line feeds and backslashes, counts as longs."""
    path = scratch_path(spark, "typed-report")
    long = S.compare(_lineitem(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC)
    doc = to_typed_report(long, S.prevalence_from(long), ODD_RULES)
    write_sink(doc.select(F.to_json("report").alias("report")), "json", path, mode="overwrite")
    return _r6(typed_cells(read_report(spark, "json", path), ODD_RULES), "mean")


def q_report_count_type(spark, sf_dir):
    """What a reader without a schema finds under the counts of the stored text."""
    long = S.compare(_lineitem(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC)
    doc = to_typed_report(long, S.prevalence_from(long), LINEITEM_RULES).select(F.parse_json(F.to_json("report")).alias("v"))
    cell = lambda r: F.variant_get("v", f"$.Diseases_Count.{r.name}.Count", "variant")
    rows = F.array(*(F.struct(F.lit(r.name).alias("condition"), F.schema_of_variant(cell(r)).alias("kind"), cell(r).cast("long").alias("n")) for r in LINEITEM_RULES))
    return doc.select(F.inline(rows))


def _summaries(spark, sf_dir) -> str:
    """One run per return flag; the first was written with half of its rows, then again with all."""
    path = scratch_path(spark, "summaries")
    li = _lineitem(spark, sf_dir).withColumn("run_id", F.concat(F.lit("flag-"), F.col("l_returnflag")))
    first = li.where("run_id = 'flag-A'")
    rest = li.where("run_id <> 'flag-A'")
    half = first.where("l_orderkey % 2 = 0")
    append_summaries(summarise(half.unionByName(rest), LINEITEM_RULES, LINEITEM_SPEC, "0001"), path)
    append_summaries(summarise(first, LINEITEM_RULES, LINEITEM_SPEC, "0002"), path)
    return path


def q_run_summaries(spark, sf_dir):
    """Statistics folded from the runs' stored summaries, one run having been replaced."""
    return _r6(fold(spark, _summaries(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC), "mean")


def q_run_summaries_subset(spark, sf_dir):
    return _r6(fold(spark, _summaries(spark, sf_dir), LINEITEM_RULES, LINEITEM_SPEC, ["flag-A", "flag-R", "flag-none"]), "mean")


def q_lab_model_columns(spark, sf_dir):
    """The model's input columns, in order, from flagged silver rows."""
    silver = R.all_pass_label(M.lab_features(_lab_silver(spark, sf_dir)), LAB_RULES)
    return _r6(silver.select("sample_id", *M.LAB_FEATURES, "label"), *M.LAB_FEATURES)


def q_medallion_measurements(spark, sf_dir):
    """The chain with dedup by measurements alone and twenty files per layer."""
    paths = medallion.Paths(scratch_path(spark, "measurements"))
    cfg = medallion.RunConfig(run_id="run-1", dedup="measurements", partitions=20)
    medallion.run(spark, _lab_keys(spark, sf_dir), "sample_id", paths, cfg, ("extract", "transform", "load"))
    files = spark.read.parquet(paths.silver).select(F.count_distinct("_metadata.file_path").alias("n"))
    return medallion.layer_counts(spark, paths, cfg).unionByName(files.select(F.lit("silver_files").alias("layer"), "n"))


def q_medallion_model(spark, sf_dir):
    """All four stages: rows per layer, promotions, and stages logged within the run's time."""
    paths = medallion.Paths(scratch_path(spark, "all-stages"))
    cfg = medallion.RunConfig(run_id="run-1", trees=20, depth=5)
    before = spark.range(1).select(F.current_timestamp()).first()[0]
    medallion.run(spark, _lab_keys(spark, sf_dir), "sample_id", paths, cfg)
    log = AuditLog(spark, paths.audit).read().where((F.col("ts") >= F.lit(before)) & (F.col("ts") <= F.current_timestamp()))
    stages = log.where("level = 'INFO'").select(F.lit("stages_logged").alias("layer"), F.col("source")).distinct()
    promoted = spark.read.parquet(f"{paths.registry}/promotions").select(F.lit("promotions").alias("layer"))
    more = stages.select("layer").unionAll(promoted).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))
    return medallion.layer_counts(spark, paths, cfg).unionByName(more)


def q_rf_quality(spark, sf_dir):
    """Whether a small forest beats predicting the more frequent label; one that predicts a single class does not."""
    frame = R.all_pass_label(lineitem_features(_lineitem(spark, sf_dir)), LINEITEM_RULES)
    train, test = M.hash_split(frame, train_pct=70, buckets=10, bucket=_split_bucket())
    fitted = M.train(train, LINEITEM_FEATURES, "label", trees=10, depth=5, seed=42)
    result = M.gate(spark, fitted, scratch_path(spark, "quality"), test, "run-1").first()
    share = test.agg(F.avg("label").alias("p"), F.count(F.lit(1)).alias("n")).select(F.greatest("p", 1 - F.col("p")).alias("most"), "n")
    return share.select(F.col("n").alias("n_test"), (F.lit(result["challenger_accuracy"]) > F.col("most") + (1 - F.col("most")) / 2).alias("halves_the_errors"))


# --------------------------------------------------------------------------
# oracle SQL (DuckDB dialect; double literals written as 1.0e0)
# --------------------------------------------------------------------------


def _lit(x: float) -> str:
    r = repr(float(x))
    return r if "e" in r else r + "e0"


def _hit_sql(rule: R.Rule) -> str:
    op = "=" if rule.op == "==" else rule.op
    return f"{rule.column} {op} {_lit(rule.threshold)}"


def _pass_sql(rule: R.Rule) -> str:
    from alloy.operators.rules import _NEGATED

    neg = _NEGATED[rule.op]
    return f"{rule.column} {'=' if neg == '==' else neg} {_lit(rule.threshold)}"


def _flag_sql(rule: R.Rule) -> str:
    return f"(CASE WHEN {_hit_sql(rule)} THEN 1 ELSE 0 END)"


def _label_sql(rules) -> str:
    return f"(CASE WHEN {' AND '.join(_pass_sql(r) for r in rules)} THEN 1 ELSE 0 END)"


def _flags_select(rules) -> str:
    return ", ".join(f"{_flag_sql(r)}::INTEGER AS {r.name}" for r in rules)


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _bronze_sql() -> str:
    return f"SELECT {measurement_sql(SAMPLE_KEY_SQL)} FROM lineitem"


def sql_synthetic_bronze():
    return _bronze_sql()


def sql_synthetic_flags():
    return (
        f"SELECT sample_id, {_flags_select(LAB_RULES)}, {_label_sql(LAB_RULES)}::INTEGER AS label "
        f"FROM ({_bronze_sql()}) b"
    )


def _lab_flagged_sql() -> str:
    return f"SELECT *, {_flags_select(LAB_RULES)} FROM ({_lab_silver_sql()}) s"


def _lab_compare_sql(rounded: bool = True) -> str:
    parts = []
    for r in LAB_RULES:
        for v in (0, 1):
            for m in LAB_SPEC[r.name]:
                mean = f"avg({m}) FILTER (WHERE {r.name} = {v})"
                parts.append(
                    f"SELECT '{r.name}' AS condition, {v}::INTEGER AS flag, '{m}' AS metric, "
                    f"count(*) FILTER (WHERE {r.name} = {v})::BIGINT AS n, "
                    f"{f'round({mean}, 6)' if rounded else mean} AS mean FROM lab"
                )
    return f"WITH lab AS ({_lab_flagged_sql()})\n" + _union(parts)


def sql_lab_compare_long():
    return _lab_compare_sql()


def sql_lab_prevalence():
    parts = [
        f"SELECT '{r.name}' AS condition, count(*) FILTER (WHERE {r.name} = 1)::BIGINT AS n, "
        f"count(*) FILTER (WHERE {r.name} = 1) / count(*)::DOUBLE AS rate FROM lab"
        for r in LAB_RULES
    ]
    return (
        f"WITH lab AS ({_lab_flagged_sql()}), p AS ({_union(parts)})\n"
        "SELECT condition, n, round(rate, 6) AS rate, round(n * 100.0e0 / sum(n) OVER (), 1) AS pct FROM p"
    )


def sql_lab_pivot_labels():
    def label(col: str) -> str:
        whens = []
        for cond, style in LAB_LABEL_STYLES.items():
            text = (f"CAST(trunc({col})::BIGINT AS VARCHAR)" if style == "int"
                    else f"printf('%.1f%%', round({col}, 1))")
            whens.append(f"WHEN condition = '{cond}' THEN {text}")
        return f"CASE {' '.join(whens)} END"

    pivot = (
        "SELECT condition, metric, max(CASE WHEN flag = 0 THEN mean END) AS without, "
        f"max(CASE WHEN flag = 1 THEN mean END) AS with FROM ({_lab_compare_sql(False)}) c GROUP BY condition, metric"
    )
    return (
        f'SELECT condition, metric, round(without, 6) AS without, round("with", 6) AS "with", '
        f'{label("without")} AS without_label, {label(chr(34) + "with" + chr(34))} AS with_label FROM ({pivot}) p'
    )


def sql_lab_features():
    return f"""
SELECT sample_id,
  round(motility_progressive + motility_non_progressive, 6) AS total_motility,
  round(motility_progressive / ((motility_progressive + motility_non_progressive) + 1e-6), 6) AS motility_ratio,
  round(motility_progressive * vitality, 6) AS motility_vitality_interaction,
  round((head_defects + midpiece_defects + tail_defects) / 3.0e0, 6) AS defect_ratio,
  round((vitality + motility_progressive + normal_forms) / 3.0e0, 6) AS health_index,
  {_label_sql(LAB_RULES)}::INTEGER AS label
FROM ({_lab_silver_sql()}) s"""


def sql_rounding_modes():
    return (
        "SELECT l_orderkey, l_linenumber, l_quantity / 4.0e0 AS x, "
        "round(l_quantity / 4.0e0, 1) AS half_up, round_even(l_quantity / 4.0e0, 1) AS half_even FROM lineitem"
    )


def sql_dedup_rows():
    return "SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem"


def sql_dedup_by_key():
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    rest = [c for c in cols if c not in KEY and c not in DEDUP_ORDER]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in (*DEDUP_ORDER, *rest))
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) t WHERE rn = 1"
    )


def sql_dropna_any():
    return """
WITH g AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_orderkey % 7 = 3 THEN NULL ELSE l_quantity END AS l_quantity,
    l_extendedprice,
    CASE WHEN (l_orderkey + l_linenumber) % 11 = 5 THEN 'NaN'::DOUBLE ELSE l_discount END AS l_discount,
    CASE WHEN (l_orderkey * 3 + l_linenumber) % 17 = 2 THEN 'NaN'::DOUBLE
         WHEN (l_orderkey * 3 + l_linenumber) % 17 = 9 THEN NULL ELSE l_tax END AS l_tax,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
    l_linestatus, l_shipdate
  FROM lineitem)
SELECT * FROM g WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
  AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)
  AND l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)
  AND l_discount IS NOT NULL AND NOT isnan(l_discount) AND l_tax IS NOT NULL AND NOT isnan(l_tax)
  AND l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL AND l_shipdate IS NOT NULL"""


def sql_flag_rules():
    return f"SELECT l_orderkey, l_linenumber, {_flags_select(LINEITEM_RULES)} FROM lineitem"


def sql_all_pass_label():
    return f"SELECT l_orderkey, l_linenumber, {_label_sql(LINEITEM_RULES)}::INTEGER AS label FROM lineitem"


def sql_label_flag_identity():
    total = " + ".join(_flag_sql(r) for r in LINEITEM_RULES)
    return (
        "SELECT count(*)::BIGINT AS n_rows, "
        f"count(*) FILTER (WHERE ({_label_sql(LINEITEM_RULES)} = 1) <> (({total}) = 0))::BIGINT AS violations "
        "FROM lineitem"
    )


def sql_route_conditions():
    return _union(
        f"SELECT l_orderkey, l_linenumber, '{r.name}' AS condition FROM lineitem WHERE {_hit_sql(r)}"
        for r in LINEITEM_RULES
    )


def sql_route_counts():
    return _union(
        f"SELECT '{r.name}' AS condition, count(*)::BIGINT AS n FROM lineitem WHERE {_hit_sql(r)} HAVING count(*) > 0"
        for r in LINEITEM_RULES
    )


def sql_compare_one():
    r = LINEITEM_RULES[0]
    avgs = ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in LINEITEM_SPEC[r.name])
    return f"SELECT {_flag_sql(r)}::INTEGER AS {r.name}, count(*)::BIGINT AS n, {avgs} FROM lineitem GROUP BY 1"


def _compare_long_sql(rounded: bool = True) -> str:
    parts = []
    for r in LINEITEM_RULES:
        for v in (0, 1):
            for m in LINEITEM_SPEC[r.name]:
                mean = f"avg({m}) FILTER (WHERE {_flag_sql(r)} = {v})"
                parts.append(
                    f"SELECT '{r.name}' AS condition, {v}::INTEGER AS flag, '{m}' AS metric, "
                    f"count(*) FILTER (WHERE {_flag_sql(r)} = {v})::BIGINT AS n, "
                    f"{f'round({mean}, 6)' if rounded else mean} AS mean FROM lineitem"
                )
    return _union(parts)


def sql_compare_long():
    return _compare_long_sql()


def _pivot_sql() -> str:
    return (
        "SELECT condition, metric, max(CASE WHEN flag = 0 THEN mean END) AS without, "
        f"max(CASE WHEN flag = 1 THEN mean END) AS with FROM ({_compare_long_sql(False)}) c GROUP BY condition, metric"
    )


def sql_compare_pivot():
    return f'SELECT condition, metric, round(without, 6) AS without, round("with", 6) AS "with" FROM ({_pivot_sql()}) p'


def _prevalence_sql() -> str:
    return _union(
        f"SELECT '{r.name}' AS condition, count(*) FILTER (WHERE {_hit_sql(r)})::BIGINT AS n, "
        f"count(*) FILTER (WHERE {_hit_sql(r)}) / count(*)::DOUBLE AS rate FROM lineitem"
        for r in LINEITEM_RULES
    )


def sql_prevalence():
    return f"SELECT condition, n, round(rate, 6) AS rate FROM ({_prevalence_sql()}) p"


def sql_share_of_total():
    return (
        "SELECT condition, n, round(n * 100.0e0 / sum(n) OVER (), 1) AS pct "
        f"FROM ({_prevalence_sql()}) p"
    )


def sql_axis_max():
    return f'SELECT condition, round(max(greatest(without, "with")), 6) AS max FROM ({_pivot_sql()}) p GROUP BY condition'


def sql_labels_display():
    def label(col: str) -> str:
        whens = []
        for cond, style in LINEITEM_LABEL_STYLES.items():
            if style == "int":
                text = f'CAST(trunc({col})::BIGINT AS VARCHAR)'
            else:
                text = f"printf('%.1f%%', round({col}, 1))"
            whens.append(f"WHEN condition = '{cond}' THEN {text}")
        return f"CASE {' '.join(whens)} END"

    return (
        f'SELECT condition, metric, {label("without")} AS without_label, {label(chr(34) + "with" + chr(34))} AS with_label '
        f"FROM ({_pivot_sql()}) p"
    )


def sql_features():
    return (
        "SELECT l_orderkey, l_linenumber, "
        "round(l_extendedprice / (l_quantity + 1e-6), 6) AS price_ratio, "
        "round(l_discount * l_tax, 6) AS disc_tax_interaction, "
        "round((l_discount + l_tax + l_quantity) / 3.0e0, 6) AS rate_mean FROM lineitem"
    )


def sql_hash_split():
    b = "((l_orderkey * 31 + l_linenumber) % 10)"
    return (
        f"SELECT 'train' AS side, count(*) FILTER (WHERE {b} < 7)::BIGINT AS n FROM lineitem "
        f"UNION ALL SELECT 'test' AS side, count(*) FILTER (WHERE {b} >= 7)::BIGINT AS n FROM lineitem"
    )


def sql_scale_unit_std():
    return (
        "SELECT l_orderkey, l_linenumber, "
        "round(l_quantity / stddev_samp(l_quantity) OVER (), 6) AS quantity_scaled, "
        "round(l_extendedprice / stddev_samp(l_extendedprice) OVER (), 6) AS price_scaled FROM lineitem"
    )


def _pred_sql() -> str:
    pred = f"(CASE WHEN {' AND '.join(_pass_sql(r) for r in PARTIAL_RULES)} THEN 1 ELSE 0 END)"
    return f"SELECT {_label_sql(LINEITEM_RULES)} AS label, {pred} AS prediction FROM lineitem"


def sql_confusion_matrix():
    return (
        "SELECT label::INTEGER AS label, prediction::INTEGER AS prediction, count(*)::BIGINT AS n "
        f"FROM ({_pred_sql()}) p GROUP BY 1, 2"
    )


def _f1_sql() -> str:
    return f"""
WITH p AS ({_pred_sql()}),
c AS (SELECT cls,
        sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp
      FROM (SELECT label AS cls, 1 AS support, 0 AS predicted, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp FROM p
            UNION ALL SELECT prediction AS cls, 0, 1, 0 FROM p) x GROUP BY cls),
m AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0e0 ELSE tp / predicted::DOUBLE END AS prec,
               CASE WHEN support = 0 THEN 0.0e0 ELSE tp / support::DOUBLE END AS rec FROM c),
f AS (SELECT *, CASE WHEN prec + rec = 0 THEN 0.0e0 ELSE 2 * prec * rec / (prec + rec) END AS f1 FROM m)
SELECT round(sum(f1 * support) / sum(support), 9) AS f1, round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy"""


def sql_confusion_f1():
    return _f1_sql() + ", sum(support)::BIGINT AS n FROM f"


def sql_evaluator_f1():
    return _f1_sql() + " FROM f"


def sql_report_json():
    analysis = (
        "SELECT condition || '_Analysis' AS section, flag::VARCHAR AS key, metric AS field, round(mean, 6) AS value "
        f"FROM ({_compare_long_sql(False)}) c"
    )
    counts = f"SELECT 'Diseases_Count' AS section, condition AS key, 'Count' AS field, n::DOUBLE AS value FROM ({_prevalence_sql()}) p"
    return _union([analysis, counts])


def sql_report_section():
    r = LINEITEM_RULES[0]
    return (
        "SELECT flag::VARCHAR AS key, metric AS field, round(mean, 6) AS value "
        f"FROM ({_compare_long_sql(False)}) c WHERE condition = '{r.name}'"
    )


def sql_gold_partition_read():
    rules = [r for r in LINEITEM_RULES if r.name in GOLD_READ]
    return _union(
        f"SELECT '{r.name}' AS condition, count(*)::BIGINT AS n, sum(l_quantity) AS sum_qty, "
        f"max(l_orderkey) AS max_orderkey FROM lineitem WHERE {_hit_sql(r)} HAVING count(*) > 0"
        for r in rules
    )


def sql_dashboard_bars():
    return sql_labels_display().replace(
        "SELECT condition, metric, ",
        'SELECT condition, metric, round(without, 6) AS without, round("with", 6) AS "with", ',
        1,
    )


def _lab_silver_sql() -> str:
    return f"SELECT DISTINCT * FROM ({_bronze_sql()}) b"


def sql_medallion_rerun():
    silver = f"SELECT * FROM ({_lab_silver_sql()}) s WHERE sample_id % 2 = 0"
    parts = [
        "SELECT 'bronze' AS layer, count(*)::BIGINT AS n FROM lineitem WHERE (l_orderkey * 8 + l_linenumber) % 2 = 0",
        f"SELECT 'silver' AS layer, count(*)::BIGINT AS n FROM ({silver}) s",
        f"SELECT 'sink_rows' AS layer, count(*)::BIGINT AS n FROM ({_lab_silver_sql()}) s",
    ]
    parts += [
        f"SELECT 'gold_{r.name}' AS layer, count(*)::BIGINT AS n FROM ({silver}) s WHERE {_hit_sql(r)} HAVING count(*) > 0"
        for r in LAB_RULES
    ]
    parts += [
        f"SELECT 'sink_day-{day + 1}' AS layer, count(*)::BIGINT AS n FROM ({_lab_silver_sql()}) s WHERE sample_id % 2 = {day}"
        for day in (0, 1)
    ]
    return _union(parts)


def sql_medallion_custom_rules():
    return _union(
        f"SELECT '{r.name}' AS flag, count(*) FILTER (WHERE {_hit_sql(r)})::BIGINT AS n, {len(rules)}::INTEGER AS n_rules FROM ({_lab_silver_sql()}) s"
        for rules in (LAB_RULES[:3], MORE_RULES) for r in rules
    )


def sql_dedup_measurements():
    cols = ", ".join(COARSE)
    return f"SELECT min(sample_id) AS sample_id, {cols} FROM ({_bronze_sql()}) b GROUP BY {cols}"


def sql_section_available():
    rows = ", ".join([f"('{r.name}_Analysis', true)" for r in LINEITEM_RULES] + ["('Diseases_Count', true)", "('Absent_Analysis', false)"])
    return f"SELECT section, available FROM (VALUES {rows}) t(section, available) WHERE (SELECT count(*) FROM lineitem) > 0"


def sql_rf_gate():
    return f"""
WITH t AS (SELECT count(*)::BIGINT AS n_test FROM lineitem WHERE (l_orderkey * 31 + l_linenumber) % 10 >= 7)
SELECT 'attempt-1' AS run_id, true AS promoted, false AS had_champion, false AS scores_equal, n_test FROM t
UNION ALL SELECT 'attempt-2', false, true, true, n_test FROM t"""


def sql_report_document():
    names = ", ".join(f"'{s}'" for s in sorted([f"{r.name}_Analysis" for r in LINEITEM_RULES] + ["Diseases_Count"]))
    return f"SELECT true AS titled, [{names}] AS sections WHERE (SELECT count(*) FROM lineitem) > 0"


def sql_uniform_bronze():
    return uniform_sql(SAMPLE_KEY_SQL, "lineitem")


def sql_uniform_bronze_seeded():
    wide = f"({SAMPLE_KEY_SQL}) * 15000000000000 * (CASE WHEN ({SAMPLE_KEY_SQL}) % 2 = 0 THEN -1 ELSE 1 END)"
    return uniform_sql(wide, "lineitem", SECOND_SEED)


def sql_uniform_identities():
    return "SELECT count(*)::BIGINT AS n, 0::BIGINT AS violations FROM lineitem"


def _text_sql(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql_report_typed():
    label = "CASE " + " ".join(f"WHEN condition = '{r.name}' THEN {_text_sql(r.label)}" for r in ODD_RULES) + " END"
    return f"""
SELECT {label} || '_Analysis' AS section, flag::VARCHAR AS key, metric AS field, mean, NULL::BIGINT AS n
FROM ({_compare_long_sql()}) c
UNION ALL
SELECT 'Diseases_Count', {label}, 'Count', NULL, n FROM ({_prevalence_sql()}) p"""


def sql_report_count_type():
    return f"SELECT condition, 'BIGINT' AS kind, n FROM ({_prevalence_sql()}) p"


def sql_run_summaries():
    return _compare_long_sql()


def sql_run_summaries_subset():
    return f"WITH chosen AS (SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R'))\n" + _compare_long_sql().replace("FROM lineitem", "FROM chosen")


def sql_lab_model_columns():
    derived = sql_lab_features()
    columns = ", ".join(f"round(s.{c}, 6) AS {c}" for c in M.LAB_FEATURES[:8]) + ", " + ", ".join(f"d.{c}" for c in M.LAB_FEATURES[8:])
    return f"SELECT s.sample_id, {columns}, d.label FROM ({_lab_silver_sql()}) s JOIN ({derived}) d USING (sample_id)"


def _layers_sql(silver: str) -> list[str]:
    parts = ["SELECT 'bronze' AS layer, count(*)::BIGINT AS n FROM lineitem"]
    parts += [f"SELECT '{x}' AS layer, count(*)::BIGINT AS n FROM ({silver}) s" for x in ("silver", "sink_rows")]
    return parts + [
        f"SELECT 'gold_{r.name}' AS layer, count(*)::BIGINT AS n FROM ({silver}) s WHERE {_hit_sql(r)} HAVING count(*) > 0" for r in LAB_RULES
    ]


def sql_medallion_measurements():
    silver = f"SELECT DISTINCT * EXCLUDE (sample_id) FROM ({_lab_silver_sql()}) b"
    return _union([*_layers_sql(silver), "SELECT 'silver_files' AS layer, 20::BIGINT AS n"])


def sql_medallion_model():
    return _union([*_layers_sql(_lab_silver_sql()), "SELECT 'stages_logged' AS layer, 4::BIGINT AS n", "SELECT 'promotions' AS layer, 1::BIGINT AS n"])


def sql_rf_quality():
    return "SELECT count(*)::BIGINT AS n_test, true AS halves_the_errors FROM lineitem WHERE (l_orderkey * 31 + l_linenumber) % 10 >= 7"


def sql_medallion_run():
    silver = _lab_silver_sql()
    parts = [
        "SELECT 'bronze' AS layer, count(*)::BIGINT AS n FROM lineitem",
        f"SELECT 'silver' AS layer, count(*)::BIGINT AS n FROM ({silver}) s",
    ]
    parts += [
        f"SELECT 'gold_{r.name}' AS layer, count(*)::BIGINT AS n FROM ({silver}) s WHERE {_hit_sql(r)} HAVING count(*) > 0"
        for r in LAB_RULES
    ]
    parts.append(f"SELECT 'sink_rows' AS layer, count(*)::BIGINT AS n FROM ({silver}) s")
    return _union(parts)


def sql_audit_log():
    silver = _lab_silver_sql()
    hits = " + ".join(_flag_sql(r) for r in LAB_RULES)
    return _union(
        [
            "SELECT 'INFO' AS level, 'extract' AS source, 'bronze rows written: ' || count(*) AS message FROM lineitem",
            f"SELECT 'INFO', 'transform', 'silver rows written: ' || count(*) FROM ({silver}) s",
            f"SELECT 'INFO', 'transform', 'gold rows written: ' || sum({hits})::BIGINT FROM ({silver}) s",
            f"SELECT 'INFO', 'load', 'report sections written: {len(LAB_RULES) + 1}'",
        ]
    )


def sql_refresh_runs_state():
    return (
        "SELECT 'flag-' || l_returnflag AS run_id, "
        "CASE WHEN l_returnflag = (SELECT min(l_returnflag) FROM lineitem) THEN '0002-b' ELSE '0001-a' END AS attempt, "
        "count(*)::BIGINT AS n, 1::BIGINT AS entries FROM lineitem GROUP BY l_returnflag"
    )


def sql_refresh_metrics():
    return _compare_long_sql()


QUERIES: dict[str, Query] = {
    "synthetic_bronze": q_synthetic_bronze,
    "synthetic_flags": q_synthetic_flags,
    "lab_compare_long": q_lab_compare_long,
    "lab_prevalence": q_lab_prevalence,
    "lab_pivot_labels": q_lab_pivot_labels,
    "lab_features": q_lab_features,
    "rounding_modes": q_rounding_modes,
    "dedup_rows": q_dedup_rows,
    "dedup_by_key": q_dedup_by_key,
    "dropna_any": q_dropna_any,
    "flag_rules": q_flag_rules,
    "all_pass_label": q_all_pass_label,
    "label_flag_identity": q_label_flag_identity,
    "route_conditions": q_route_conditions,
    "route_counts": q_route_counts,
    "compare_one": q_compare_one,
    "compare_long": q_compare_long,
    "compare_pivot": q_compare_pivot,
    "prevalence": q_prevalence,
    "share_of_total": q_share_of_total,
    "axis_max": q_axis_max,
    "labels_display": q_labels_display,
    "features": q_features,
    "hash_split": q_hash_split,
    "scale_unit_std": q_scale_unit_std,
    "confusion_matrix": q_confusion_matrix,
    "confusion_f1": q_confusion_f1,
    "evaluator_f1": q_evaluator_f1,
    "report_json": q_report_json,
    "report_document": q_report_document,
    "report_section": q_report_section,
    "gold_partition_read": q_gold_partition_read,
    "dashboard_bars": q_dashboard_bars,
    "rf_gate": q_rf_gate,
    "audit_log": q_audit_log,
    "dedup_measurements": q_dedup_measurements,
    "medallion_custom_rules": q_medallion_custom_rules,
    "medallion_rerun": q_medallion_rerun,
    "section_available": q_section_available,
    "refresh_metrics": q_refresh_metrics,
    "refresh_runs_metrics": q_refresh_runs_metrics,
    "refresh_runs_state": q_refresh_runs_state,
    "sink_published": q_sink_published,
    "medallion_run": q_medallion_run,
    "uniform_bronze": q_uniform_bronze,
    "uniform_bronze_seeded": q_uniform_bronze_seeded,
    "uniform_identities": q_uniform_identities,
    "report_typed": q_report_typed,
    "report_count_type": q_report_count_type,
    "run_summaries": q_run_summaries,
    "run_summaries_subset": q_run_summaries_subset,
    "lab_model_columns": q_lab_model_columns,
    "medallion_measurements": q_medallion_measurements,
    "medallion_model": q_medallion_model,
    "rf_quality": q_rf_quality,
}

ORACLE: dict[str, Callable[[], str]] = {
    "synthetic_bronze": sql_synthetic_bronze,
    "synthetic_flags": sql_synthetic_flags,
    "lab_compare_long": sql_lab_compare_long,
    "lab_prevalence": sql_lab_prevalence,
    "lab_pivot_labels": sql_lab_pivot_labels,
    "lab_features": sql_lab_features,
    "rounding_modes": sql_rounding_modes,
    "dedup_rows": sql_dedup_rows,
    "dedup_by_key": sql_dedup_by_key,
    "dropna_any": sql_dropna_any,
    "flag_rules": sql_flag_rules,
    "all_pass_label": sql_all_pass_label,
    "label_flag_identity": sql_label_flag_identity,
    "route_conditions": sql_route_conditions,
    "route_counts": sql_route_counts,
    "compare_one": sql_compare_one,
    "compare_long": sql_compare_long,
    "compare_pivot": sql_compare_pivot,
    "prevalence": sql_prevalence,
    "share_of_total": sql_share_of_total,
    "axis_max": sql_axis_max,
    "labels_display": sql_labels_display,
    "features": sql_features,
    "hash_split": sql_hash_split,
    "scale_unit_std": sql_scale_unit_std,
    "confusion_matrix": sql_confusion_matrix,
    "confusion_f1": sql_confusion_f1,
    "evaluator_f1": sql_evaluator_f1,
    "report_json": sql_report_json,
    "report_section": sql_report_section,
    "gold_partition_read": sql_gold_partition_read,
    "dashboard_bars": sql_dashboard_bars,
    "audit_log": sql_audit_log,
    "dedup_measurements": sql_dedup_measurements,
    "medallion_custom_rules": sql_medallion_custom_rules,
    "medallion_rerun": sql_medallion_rerun,
    "report_document": sql_report_document,
    "rf_gate": sql_rf_gate,
    "section_available": sql_section_available,
    "refresh_metrics": sql_refresh_metrics,
    "refresh_runs_metrics": sql_refresh_metrics,
    "refresh_runs_state": sql_refresh_runs_state,
    "sink_published": sql_refresh_metrics,
    "medallion_run": sql_medallion_run,
    "uniform_bronze": sql_uniform_bronze,
    "uniform_bronze_seeded": sql_uniform_bronze_seeded,
    "uniform_identities": sql_uniform_identities,
    "report_typed": sql_report_typed,
    "report_count_type": sql_report_count_type,
    "run_summaries": sql_run_summaries,
    "run_summaries_subset": sql_run_summaries_subset,
    "lab_model_columns": sql_lab_model_columns,
    "medallion_measurements": sql_medallion_measurements,
    "medallion_model": sql_medallion_model,
    "rf_quality": sql_rf_quality,
}
