"""Operator unit tests: boundaries, nulls, NaN, duplicates, empty inputs."""

import math

from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from alloy.operators import clean as C
from alloy.operators import rules as R
from alloy.operators import stats as S

RULES = (R.Rule("low_a", "a", "<", 10.0), R.Rule("low_b", "b", "<", 0.5))
SPEC = {"low_a": ("a",), "low_b": ("b", "a")}
SCHEMA = StructType([StructField("id", LongType()), StructField("a", DoubleType()), StructField("b", DoubleType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_threshold_boundaries(spark):
    df = frame(spark, [(1, 9.9, 0.6), (2, 10.0, 0.5), (3, 10.1, 0.4)])
    out = {r["id"]: r for r in R.all_pass_label(R.flag(df, RULES), RULES).collect()}
    assert (out[1]["low_a"], out[2]["low_a"], out[3]["low_a"]) == (1, 0, 0)  # value = threshold is not flagged
    assert (out[1]["low_b"], out[2]["low_b"], out[3]["low_b"]) == (0, 0, 1)
    assert (out[1]["label"], out[2]["label"], out[3]["label"]) == (0, 1, 0)  # and passes under >=


def test_null_flags_zero_and_label_zero(spark):
    df = frame(spark, [(1, None, 0.9)])
    row = R.all_pass_label(R.flag(df, RULES), RULES).first()
    assert row["low_a"] == 0 and row["low_b"] == 0
    assert row["label"] == 0  # null makes the conjunction null -> 0, unlike 1 - max(flags)


def test_nan_passes_threshold_so_clean_first(spark):
    df = frame(spark, [(1, float("nan"), 0.9), (2, 5.0, 0.9)])
    flagged = {r["id"]: r for r in R.all_pass_label(R.flag(df, RULES), RULES).collect()}
    assert flagged[1]["low_a"] == 0 and flagged[1]["label"] == 1
    assert [r["id"] for r in C.drop_incomplete(df).collect()] == [2]


def test_drop_incomplete_null_nan_both_none(spark):
    df = frame(spark, [(1, None, 1.0), (2, float("nan"), 1.0), (3, None, float("nan")), (4, 1.0, 1.0), (None, 1.0, 1.0)])
    assert sorted(r["id"] for r in C.drop_incomplete(df).collect()) == [4]
    assert sorted((r["id"] for r in C.drop_incomplete(df, ["b"]).collect()), key=str) == [1, 2, 4, None]


def test_dedup_whole_row_nulls_nan_negative_zero(spark):
    df = frame(spark, [(1, None, 0.0), (1, None, -0.0), (2, float("nan"), 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0)])
    out = C.dedup(df).collect()
    assert len(out) == 3


def test_dedup_by_key_survivor_is_smallest_by_order(spark):
    df = frame(spark, [(1, 5.0, 0.2), (1, 3.0, 0.9), (1, 3.0, 0.1), (2, 7.0, 0.0)])
    out = {r["id"]: (r["a"], r["b"]) for r in C.dedup(df, keys=["id"], order=["a"]).collect()}
    assert out == {1: (3.0, 0.1), 2: (7.0, 0.0)}


def test_dedup_independent_of_partitioning(spark):
    rows = [(i % 50, float(i % 7), float(i % 3)) for i in range(2000)]
    df = frame(spark, rows)
    a = sorted(C.dedup(df, keys=["id"], order=["a", "b"]).collect())
    b = sorted(C.dedup(df.repartition(13), keys=["id"], order=["a", "b"]).collect())
    c = sorted(C.dedup(df.repartition(1), keys=["id"], order=["a", "b"]).collect())
    assert a == b == c and len(a) == 50
    assert sorted(C.dedup(df).collect()) == sorted(C.dedup(df.repartition(9)).collect())


def test_clean_is_idempotent(spark):
    df = frame(spark, [(1, 1.0, 1.0), (1, 1.0, 1.0), (2, None, 1.0), (3, float("nan"), 2.0)])
    once = C.drop_incomplete(C.dedup(df))
    twice = C.drop_incomplete(C.dedup(once))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_route_overlapping_and_long(spark):
    df = R.flag(frame(spark, [(1, 1.0, 0.1), (2, 1.0, 0.9), (3, 50.0, 0.9)]), RULES)
    routed = R.route(df, RULES)
    assert sorted(r["id"] for r in routed["low_a"].collect()) == [1, 2]
    assert sorted(r["id"] for r in routed["low_b"].collect()) == [1]
    long = R.route_long(df, RULES)
    assert sorted((r["id"], r["condition"]) for r in long.collect()) == [(1, "low_a"), (1, "low_b"), (2, "low_a")]


def test_compare_empty_class_has_zero_n_and_null_mean(spark):
    df = frame(spark, [(1, 50.0, 0.9), (2, 60.0, 0.8)])  # nobody is low_a
    out = {(r["condition"], r["flag"], r["metric"]): r for r in S.compare(df, RULES, SPEC).collect()}
    assert out[("low_a", 1, "a")]["n"] == 0 and out[("low_a", 1, "a")]["mean"] is None
    assert out[("low_a", 0, "a")]["n"] == 2 and math.isclose(out[("low_a", 0, "a")]["mean"], 55.0)
    piv = {(r["condition"], r["metric"]): r for r in S.compare_pivot(S.compare(df, RULES, SPEC)).collect()}
    assert piv[("low_a", "a")]["with"] is None and math.isclose(piv[("low_a", "a")]["without"], 55.0)


def test_compare_mean_ignores_null_metric(spark):
    df = frame(spark, [(1, 1.0, None), (2, 2.0, 0.9), (3, 3.0, 0.7)])
    out = {(r["condition"], r["flag"], r["metric"]): r for r in S.compare(df, RULES, SPEC).collect()}
    row = out[("low_a", 1, "a")]
    assert row["n"] == 3 and math.isclose(row["mean"], 2.0)


def test_empty_table_every_operator_keeps_schema(spark):
    df = frame(spark, [])
    assert R.flag(df, RULES).columns == ["id", "a", "b", "low_a", "low_b"]
    assert C.dedup(df).count() == 0 and C.dedup(df, ["id"], ["a"]).count() == 0
    assert C.drop_incomplete(df).count() == 0
    assert R.route_long(R.flag(df, RULES), RULES).count() == 0
    comp = S.compare(df, RULES, SPEC).collect()
    assert len(comp) == 6 and all(r["n"] == 0 and r["mean"] is None for r in comp)
    prev = S.prevalence(df, RULES).collect()
    assert [r["n"] for r in prev] == [0, 0] and all(r["rate"] is None for r in prev)
    assert all(r["pct"] is None for r in S.share(S.prevalence(df, RULES)).collect())


def test_shares_sum_to_100(spark):
    rows = [(i, float(i % 20), (i % 10) / 10.0) for i in range(1000)]
    out = S.share(S.prevalence(frame(spark, rows), RULES)).collect()
    assert abs(sum(r["pct"] for r in out) - 100.0) <= 0.1 * len(RULES)


def test_display_labels_truncate_and_percent(spark):
    pivot = spark.createDataFrame(
        [("x", "m", 7.5, 12.25), ("y", "m", 31.94, None)], "condition string, metric string, without double, with double"
    )
    out = {r["condition"]: r for r in S.display_labels(pivot, {"x": "int", "y": "percent"}).collect()}
    assert (out["x"]["without_label"], out["x"]["with_label"]) == ("7", "12")
    assert out["y"]["without_label"] == "31.9%" and out["y"]["with_label"] is None
    mx = {r["condition"]: r["max"] for r in S.axis_max(pivot).collect()}
    assert mx == {"x": 12.25, "y": 31.94}
