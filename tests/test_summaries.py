"""Run summaries and the typed report."""

import json

import pytest
from pyspark.sql import functions as F

from alloy.operators import stats as S
from alloy.operators.rules import Rule
from alloy.operators.summaries import append_summaries, fold, summarise
from alloy.plans.report import to_typed_report, typed_cells, typed_report_schema

RULES = (Rule("low", "x", "<", 5.0, 'Low "x"\nline'), Rule("high", "x", ">", 8.0, "Hóch\\wert"))
SPEC = {"low": ("y",), "high": ("x", "y")}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "run_id string, x double, y double")


def _key(df):
    return sorted((r["condition"], r["flag"], r["metric"], r["n"], r["mean"]) for r in df.collect())


def test_replaced_repeated_and_chosen_runs(spark, tmp_dir):
    one = _rows(spark, [("a", 1.0, 2.0), ("a", 9.0, None), ("b", 7.0, 4.0)])
    append_summaries(summarise(_rows(spark, [("a", 100.0, 100.0)]), RULES, SPEC, "1"), tmp_dir)
    for _ in range(2):  # a retried append changes nothing
        append_summaries(summarise(one, RULES, SPEC, "2"), tmp_dir)
    assert _key(fold(spark, tmp_dir, RULES, SPEC)) == _key(S.compare(one, RULES, SPEC))
    only = one.where("run_id = 'b'")
    assert [x[:4] for x in _key(fold(spark, tmp_dir, RULES, SPEC, ["b", "none"]))] == [x[:4] for x in _key(S.compare(only, RULES, SPEC))]
    empty = fold(spark, tmp_dir, RULES, SPEC, ["none"]).collect()
    assert {(r["n"], r["mean"]) for r in empty} == {(0, None)}


def test_one_row_per_run_and_no_rescan(spark, tmp_dir):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 50).cast("string"))).alias("run_id"),
                                      (F.col("id") % 11).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    summary = summarise(rows, RULES, SPEC, "1")
    assert summary.count() == rows.select("run_id").distinct().count()
    append_summaries(summary, tmp_dir)
    got, want = _key(fold(spark, tmp_dir, RULES, SPEC)), _key(S.compare(rows, RULES, SPEC))
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert [x[4] for x in got] == pytest.approx([x[4] for x in want])


def test_typed_report_round_trip(spark):
    rows = _rows(spark, [("a", 1.0, 2.0), ("a", 9.0, 3.0), ("b", 7.0, 4.0)])
    long = S.compare(rows, RULES, SPEC)
    doc = to_typed_report(long, S.prevalence_from(long), RULES, {"y": 'Avg "y"'})
    assert doc.schema["report"].dataType.simpleString() == typed_report_schema(RULES).simpleString()
    text = doc.select(F.to_json("report").alias("report"))
    parsed = json.loads(text.first()[0])
    assert parsed["Diseases_Count"] == {'Low "x"\nline': {"Count": 1}, "Hóch\\wert": {"Count": 1}}
    assert '"Count":1}' in text.first()[0]
    assert parsed['Low "x"\nline_Analysis'] == {"0": {'Avg "y"': 3.5}, "1": {'Avg "y"': 2.0}}
    cells = lambda d: sorted(map(str, typed_cells(d, RULES).collect()))
    assert cells(text) == cells(doc) and len(cells(doc)) == 2 + 4 + 2


def test_typed_report_without_rows_of_a_condition(spark):
    long = S.compare(_rows(spark, [("a", 1.0, 2.0)]), RULES, SPEC)
    doc = to_typed_report(long.where("condition = 'low'"), S.prevalence_from(long), RULES)
    assert doc.first()["report"]["Hóch\\wert_Analysis"] is None
    assert {r["section"] for r in typed_cells(doc, RULES).collect()} == {'Low "x"\nline_Analysis', "Diseases_Count"}
