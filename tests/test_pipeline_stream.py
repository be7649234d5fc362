"""Layers, report round trip, audit, medallion re-runs and the refresh stream."""

import math

import pytest
from pyspark.sql import functions as F

from alloy.operators import stats as S
from alloy.plans import medallion
from alloy.plans.audit import AuditLog
from alloy.plans.report import as_document, from_report, report_long, to_report
from alloy.sources.generate import LAB_RULES, LAB_SPEC, measurements
from alloy.sources.layers import BRONZE_SCHEMA, SchemaMismatch, read_layer, read_report, write_layer, write_sink
from alloy.sources.tables import LINEITEM_RULES, LINEITEM_SPEC, read_table
from alloy.streaming.refresh import latest, refresh
from sf_dirs import SF_SMALL


def test_read_layer_rejects_drift(spark, tmp_dir):
    df = measurements(spark, 100)
    write_layer(df.withColumn("ph", F.col("ph").cast("string")), f"{tmp_dir}/bad")
    with pytest.raises(SchemaMismatch):
        read_layer(spark, f"{tmp_dir}/bad", BRONZE_SCHEMA)
    write_layer(df.drop("ph"), f"{tmp_dir}/missing")
    with pytest.raises(SchemaMismatch):
        read_layer(spark, f"{tmp_dir}/missing", BRONZE_SCHEMA)
    n = write_layer(df, f"{tmp_dir}/good", partitions=3)
    assert n == 100 and read_layer(spark, f"{tmp_dir}/good", BRONZE_SCHEMA).count() == 100


def test_report_round_trip(spark, tmp_dir):
    df = measurements(spark, 3000)
    long = S.compare(df, LAB_RULES, LAB_SPEC)
    counts = S.prevalence(df, LAB_RULES)
    rep = to_report(long, counts, LAB_RULES)
    text = rep.first()["report"]
    assert text.startswith('{"Asthenozoospermia_Analysis":') and '"Diseases_Count":{' in text
    write_sink(as_document(rep), "json", f"{tmp_dir}/report", mode="overwrite")
    from alloy.plans.report import REPORT_TYPE
    from pyspark.sql.types import StructField, StructType

    stored = read_report(spark, "json", f"{tmp_dir}/report", schema=StructType([StructField("report", REPORT_TYPE)]))
    back_long, back_counts = report_long(from_report(stored), LAB_RULES)
    exp = {(r["condition"], r["flag"], r["metric"]): r["mean"] for r in long.collect()}
    got = {(r["condition"], r["flag"], r["metric"]): r["mean"] for r in back_long.collect()}
    assert exp.keys() == got.keys() and all(math.isclose(exp[k], got[k], rel_tol=1e-15) for k in exp)
    assert {r["condition"]: r["n"] for r in back_counts.collect()} == {r["condition"]: r["n"] for r in counts.collect()}


def test_prevalence_from_compare_equals_prevalence(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    a = sorted(S.prevalence(li, LINEITEM_RULES).collect())
    b = sorted(S.prevalence_from(S.compare(li, LINEITEM_RULES, LINEITEM_SPEC)).collect())
    assert [(r[0], r[1]) for r in a] == [(r[0], r[1]) for r in b]
    assert all(math.isclose(x[2], y[2]) for x, y in zip(a, b))


def test_sink_rerun_same_run_id_is_idempotent(spark, tmp_dir):
    df = measurements(spark, 500)
    write_sink(df, "parquet", f"{tmp_dir}/rows", run_id="r1")
    write_sink(df, "parquet", f"{tmp_dir}/rows", run_id="r1")
    write_sink(df.limit(10), "parquet", f"{tmp_dir}/rows", run_id="r2")
    counts = {r["run_id"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/rows").groupBy("run_id").count().collect()}
    assert counts == {"r1": 500, "r2": 10}


def test_medallion_chain_and_rerun(spark, tmp_dir):
    keys = read_table(spark, SF_SMALL, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    paths = medallion.Paths(f"{tmp_dir}/chain")
    cfg = medallion.RunConfig(run_id="day-1", trees=3, depth=3)
    out = medallion.run(spark, keys, "k", paths, cfg)
    assert out["extract"] == keys.count()
    assert out["transform"]["silver"] == keys.distinct().count()
    assert out["model"].first()["promoted"]
    first = sorted(medallion.layer_counts(spark, paths, cfg).collect())
    medallion.run(spark, keys, "k", paths, cfg, stages=("extract", "transform", "load"))
    assert sorted(medallion.layer_counts(spark, paths, cfg).collect()) == first
    audit = AuditLog(spark, paths.audit).read()
    assert audit.filter("level = 'INFO'").count() == 5 + 4
    assert {r["source"] for r in audit.collect()} == {"extract", "transform", "model", "load"}


def test_failed_stage_is_logged_and_raised(spark, tmp_dir):
    paths = medallion.Paths(f"{tmp_dir}/broken")
    with pytest.raises(Exception):
        medallion.run(spark, None, "k", paths, medallion.RunConfig(run_id="d"), stages=("transform",))
    rows = AuditLog(spark, paths.audit).read().collect()
    assert [(r["level"], r["source"]) for r in rows] == [("ERROR", "transform")]
    assert "PATH_NOT_FOUND" in rows[0]["message"]  # the reason, not only the error's class


def test_refresh_restart_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    li = read_table(spark, SF_SMALL, "lineitem")
    parts = li.randomSplit([1.0, 1.0, 1.0], seed=7)
    parts[0].write.mode("append").parquet(src)
    schema = li.schema
    kw = dict(dst=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ck", max_files_per_trigger=1)
    refresh(spark, src, schema, LINEITEM_RULES, LINEITEM_SPEC, **kw).awaitTermination()
    parts[1].write.mode("append").parquet(src)
    parts[2].write.mode("append").parquet(src)
    # restart from the checkpoint: only the new files are read, state carries over
    refresh(spark, src, schema, LINEITEM_RULES, LINEITEM_SPEC, **kw).awaitTermination()
    # a third start with nothing new changes nothing
    refresh(spark, src, schema, LINEITEM_RULES, LINEITEM_SPEC, **kw).awaitTermination()
    got = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"]) for r in latest(spark, f"{tmp_dir}/out").collect()}
    exp = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"])
           for r in S.compare(li, LINEITEM_RULES, LINEITEM_SPEC).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k][0] == exp[k][0] and math.isclose(got[k][1], exp[k][1], rel_tol=1e-12)


def test_report_section_access(spark):
    from alloy.plans.report import report_section

    df = measurements(spark, 2000)
    rep = to_report(S.compare(df, LAB_RULES, LAB_SPEC), S.prevalence(df, LAB_RULES), LAB_RULES)
    counts = {r["key"]: r["value"] for r in report_section(rep, "Diseases_Count").collect()}
    prev = {r.label: n for r in LAB_RULES for c, n in [(x["condition"], x["n"]) for x in S.prevalence(df, LAB_RULES).collect()] if c == r.name}
    assert counts == {k: float(v) for k, v in prev.items()}
    cells = report_section(rep, "Necrospermia_Analysis").collect()
    assert sorted({c["key"] for c in cells}) == ["0", "1"] and {c["field"] for c in cells} == {"vitality"}


def test_report_metric_labels_round_trip(spark):
    from alloy.sources.generate import LAB_METRIC_LABELS

    df = measurements(spark, 1500)
    long = S.compare(df, LAB_RULES, LAB_SPEC)
    rep = to_report(long, S.prevalence_from(long), LAB_RULES, LAB_METRIC_LABELS)
    text = rep.first()["report"]
    assert '"Avg Sperm concentration (x10⁶/mL)":' in text and '"Oligospermia_Analysis":{"0":{' in text
    back, _ = report_long(from_report(rep), LAB_RULES, LAB_METRIC_LABELS)
    got = {(r["condition"], r["flag"], r["metric"]) for r in back.collect()}
    assert got == {(r["condition"], r["flag"], r["metric"]) for r in long.collect()}


def test_observed_statistics_equal_compare(spark, tmp_dir):
    df = measurements(spark, 3000, partitions=4)
    observed, result = S.observe_compare(df, LAB_RULES, LAB_SPEC)
    observed.write.mode("overwrite").parquet(f"{tmp_dir}/obs")
    got = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"]) for r in result(spark).collect()}
    exp = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"]) for r in S.compare(df, LAB_RULES, LAB_SPEC).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k][0] == exp[k][0]
        assert (got[k][1] is None and exp[k][1] is None) or math.isclose(got[k][1], exp[k][1], rel_tol=1e-12)


def test_medallion_report_matches_silver_statistics(spark, tmp_dir):
    from alloy.plans.report import REPORT_TYPE
    from alloy.sources.generate import LAB_METRIC_LABELS
    from alloy.sources.layers import SILVER_SCHEMA
    from pyspark.sql.types import StructField, StructType

    keys = read_table(spark, SF_SMALL, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    paths = medallion.Paths(f"{tmp_dir}/chain")
    medallion.run(spark, keys, "k", paths, medallion.RunConfig(run_id="d1"), stages=("extract", "transform", "load"))
    stored = read_report(spark, "json", paths.report_sink, schema=StructType([StructField("report", REPORT_TYPE)]))
    back, counts = report_long(from_report(stored), LAB_RULES, LAB_METRIC_LABELS)
    silver = read_layer(spark, paths.silver, SILVER_SCHEMA)
    exp = {(r["condition"], r["flag"], r["metric"]): r["mean"] for r in S.compare(silver, LAB_RULES, LAB_SPEC).collect()}
    got = {(r["condition"], r["flag"], r["metric"]): r["mean"] for r in back.collect()}
    assert got.keys() == exp.keys() and all(math.isclose(got[k], exp[k], rel_tol=1e-12) for k in exp)
    assert {r["condition"]: r["n"] for r in counts.collect()} == {
        r["condition"]: r["n"] for r in S.prevalence(silver, LAB_RULES).collect()
    }


def test_command_line_runs_stages(spark, tmp_dir):
    from alloy.__main__ import main

    out = main(["--root", f"{tmp_dir}/cli", "--run-id", "cli", "--rows", "3000", "--stages", "extract,transform,model,load",
                "--trees", "3", "--depth", "3", "--run-id", "cli-1"], spark=spark)
    assert out["extract"] == 3000 and out["transform"]["silver"] == 3000
    assert out["model"]["promoted"] is True and out["load"]["report_sections"] == 6


def test_audit_table_created_before_any_event(spark, tmp_dir):
    log = AuditLog(spark, f"{tmp_dir}/audit")
    log.ensure()
    df = log.read()
    # parquet reads report every column as nullable; NOT NULL is checked when rows are written
    assert df.count() == 0 and [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("ts", "timestamp"), ("level", "string"), ("source", "string"), ("message", "string")
    ]
    log.info("x", "hello")
    log.ensure()
    assert log.flush() == 1 and log.read().count() == 1


def test_audit_ensure_does_not_rewrite_existing_table(spark, tmp_dir):
    import os

    path = f"{tmp_dir}/audit2"
    log = AuditLog(spark, path)
    log.ensure()
    before = sorted(os.listdir(path))
    log.ensure()
    assert sorted(os.listdir(path)) == before


def test_dashboard_frames_and_empty_section_guard(spark):
    from alloy.plans.dashboard import dashboard, section_available
    from alloy.sources.generate import LAB_LABEL_STYLES

    df = measurements(spark, 2000)
    long = S.compare(df, LAB_RULES, LAB_SPEC)
    rep = to_report(long, S.prevalence_from(long), LAB_RULES)
    frames = dashboard(rep, LAB_RULES, LAB_LABEL_STYLES)
    assert abs(sum(r["pct"] for r in frames["pie"].collect()) - 100.0) <= 0.5
    assert frames["bars"].count() == 11 and frames["axis"].count() == 5
    flags = rep.select(
        section_available(rep, "Oligospermia_Analysis").alias("a"), section_available(rep, "Missing_Analysis").alias("b")
    ).first()
    assert flags["a"] is True and flags["b"] is False


def test_command_line_with_keys_table(spark, tmp_dir):
    from alloy.__main__ import main

    keys_path = f"{tmp_dir}/keys"
    read_table(spark, SF_SMALL, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")
    ).write.parquet(keys_path)
    out = main(["--root", f"{tmp_dir}/cli2", "--run-id", "cli", "--keys-table", keys_path, "--key", "k",
                "--stages", "extract,transform"], spark=spark)
    keys = spark.read.parquet(keys_path)
    assert out["extract"] == keys.count() and out["transform"]["silver"] == keys.distinct().count()


def test_gold_view_equals_gold_copy(spark, tmp_dir):
    keys = read_table(spark, SF_SMALL, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    copy_paths, view_paths = medallion.Paths(f"{tmp_dir}/copy"), medallion.Paths(f"{tmp_dir}/view")
    rarest_first = ["hypospermia", "oligospermia", "necrospermia", "asthenozoospermia", "teratozoospermia"]
    copy_cfg, view_cfg = medallion.RunConfig(run_id="d"), medallion.RunConfig(run_id="d", gold_mode="view", view_order=rarest_first)
    medallion.run(spark, keys, "k", copy_paths, copy_cfg, stages=("extract", "transform"))
    out = medallion.run(spark, keys, "k", view_paths, view_cfg, stages=("extract", "transform"))
    assert out["transform"]["gold"] == 0
    for rule in LAB_RULES:
        a = sorted(medallion.gold(spark, copy_paths, rule, copy_cfg).collect())
        b = sorted(medallion.gold(spark, view_paths, rule, view_cfg).collect())
        assert a == b and len(a) > 0
    text = medallion.gold(spark, view_paths, LAB_RULES[0], view_cfg)._jdf.queryExecution().toString()
    assert "EqualTo(oligospermia,1)" in text  # the flag filter reaches the parquet reader


def test_refresh_runs_exact_under_rerun(spark, tmp_dir):
    from alloy.sources.layers import write_sink
    from alloy.streaming.refresh import refresh_runs

    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    day1, day2 = li.filter("l_orderkey % 2 = 0"), li.filter("l_orderkey % 2 = 1")
    sink, out, ck = f"{tmp_dir}/sink", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_sink(day1, "parquet", sink, run_id="d1", attempt="2026-01-01T00:00:00")
    schema = spark.read.parquet(sink).schema
    kw = dict(dst=out, checkpoint=ck)
    refresh_runs(spark, sink, schema, LINEITEM_RULES, LINEITEM_SPEC, **kw).awaitTermination()
    # day 1 is re-run (same rows, later attempt): its files are replaced and must not count twice
    write_sink(day1, "parquet", sink, run_id="d1", attempt="2026-01-01T05:00:00")
    write_sink(day2, "parquet", sink, run_id="d2", attempt="2026-01-02T00:00:00")
    refresh_runs(spark, sink, schema, LINEITEM_RULES, LINEITEM_SPEC, **kw).awaitTermination()
    got = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"]) for r in latest(spark, out).collect()}
    exp = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"])
           for r in S.compare(li, LINEITEM_RULES, LINEITEM_SPEC).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k][0] == exp[k][0] and math.isclose(got[k][1], exp[k][1], rel_tol=1e-12)


def _two_days(spark):
    from alloy.operators.rules import Rule

    li = read_table(spark, SF_SMALL, "lineitem")
    keys = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    return keys.where("k % 2 = 0"), keys.where("k % 2 = 1"), Rule


def test_layers_forget_a_condition_without_hits(spark, tmp_dir):
    day1, day2, Rule = _two_days(spark)
    paths = medallion.Paths(f"{tmp_dir}/days")
    never = Rule("never", "ph", "<", -1.0)
    for mode in ("dynamic", "static"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        always = medallion.RunConfig(run_id="d1", rules=(Rule("never", "ph", ">=", -1.0),), spec={"never": ("ph",)})
        medallion.run(spark, day1, "k", paths, always, stages=("extract", "transform"))
        cfg = medallion.RunConfig(run_id="d2", rules=(never,), spec={"never": ("ph",)})
        assert medallion.run(spark, day2, "k", paths, cfg, stages=("extract", "transform"))["transform"]["gold"] == 0
        assert "condition=never" not in str(spark.read.schema("condition string").parquet(paths.gold).inputFiles())
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_rule_sets_are_parameters(spark, tmp_dir):
    day1, _, Rule = _two_days(spark)
    for rules in (LAB_RULES[:3], (*LAB_RULES, Rule("acid", "ph", "<", 7.2))):
        for mode in ("copy", "view"):
            cfg = medallion.RunConfig(run_id="d", rules=rules, spec={r.name: ("ph",) for r in rules}, gold_mode=mode)
            paths = medallion.Paths(f"{tmp_dir}/rules-{len(rules)}-{mode}")
            medallion.run(spark, day1, "k", paths, cfg, stages=("extract", "transform", "load"))
            assert {r.name for r in rules} <= set(spark.read.parquet(paths.rows_sink).columns)
            counts = {r["layer"]: r["n"] for r in medallion.layer_counts(spark, paths, cfg).collect()}
            assert counts["silver"] == counts["sink_rows"] == day1.distinct().count()


def test_audit_options_only_sink_keeps_every_event(spark, tmp_dir):
    log = AuditLog(spark, None, "parquet", {"path": f"{tmp_dir}/log"})
    log.ensure()
    log.info("a", "one")
    assert log.flush() == 1 and log.read().count() == 1
    lost = AuditLog(spark)
    lost.info("a", "one")
    with pytest.raises(ValueError):
        lost.flush()
    assert lost.pending().count() == 1


def test_sinks_that_cannot_replace_a_run_need_an_attempt(spark, tmp_dir):
    from alloy.sources.layers import latest_attempts

    with pytest.raises(ValueError):
        write_sink(spark.range(3), "jdbc", run_id="d1")
    rows = spark.createDataFrame([("d1", "1", 1), ("d1", "2", 2), ("d1", "2", 3), ("d2", "1", 4)], "run_id string, attempt string, x int")
    assert sorted(r["x"] for r in latest_attempts(rows).collect()) == [2, 3, 4]
