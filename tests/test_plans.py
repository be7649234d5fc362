"""Physical-plan checks for the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry
from alloy.plans import catalog
from alloy.operators import clean as C
from alloy.operators import rules as R
from alloy.operators import stats as S
from alloy.plans.report import to_report
from alloy.sources.tables import LINEITEM_RULES, LINEITEM_SPEC, read_table
from sf_dirs import SF_SMALL


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M))


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.fixture(scope="module")
def li(spark):
    return read_table(spark, SF_SMALL, "lineitem")


def test_compare_is_one_pruned_scan_and_one_single_row_exchange(li):
    text = plan(S.compare(li, LINEITEM_RULES, LINEITEM_SPEC))
    assert scans(text) == 1
    assert read_schemas(text) == ["l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double"]
    exchanges = re.findall(r"Arguments: (SinglePartition|hashpartitioning|rangepartitioning|RoundRobin)", text)
    assert exchanges == ["SinglePartition"]
    assert "partial_sum" in text and "partial_count" in text


def test_prevalence_reads_rule_columns_only(li):
    text = plan(S.prevalence(li, LINEITEM_RULES))
    assert read_schemas(text) == ["l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double"]


def test_route_long_has_no_shuffle(li):
    text = plan(R.route_long(R.flag(li, LINEITEM_RULES), LINEITEM_RULES))
    assert "Exchange" not in text and "Generate" in text


def test_keyed_dedup_combines_map_side(li):
    text = plan(C.dedup(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    partial = text.index("partial_min")
    shuffle = text.index("Arguments: hashpartitioning(l_orderkey")
    assert partial < shuffle  # partial aggregate is listed (runs) before the exchange
    assert "Window" not in text


def test_whole_row_dedup_combines_map_side(li):
    text = plan(C.dedup(li.select("l_quantity", "l_discount", "l_tax")))
    assert text.count("HashAggregate") >= 2 and "Window" not in text


def test_report_shares_the_statistics_scan(spark, li):
    long = S.compare(li, LINEITEM_RULES, LINEITEM_SPEC)
    rep = to_report(long, S.prevalence_from(long), LINEITEM_RULES)
    rep.collect()
    final = rep._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_filters_reach_the_scan(li):
    from pyspark.sql import functions as F

    text = plan(R.flag(li, LINEITEM_RULES).filter(F.col("l_quantity") < 15).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_quantity), LessThan(l_quantity,15.0)]" in text


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"rf_gate", "medallion_run", "audit_log", "evaluator_f1"}))
def test_no_broadcast_cartesian_or_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_SMALL))
    if name == "sink_published":  # the manifest is broadcast by Spark's own size check, and merge-joined beyond it
        text = text.replace("BroadcastExchange", "")
    for bad in ("BroadcastExchange", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, (name, bad)
