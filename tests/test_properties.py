"""Property tests: operators against brute-force Python on random small frames."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from alloy.operators import clean as C
from alloy.operators import rules as R
from alloy.operators import stats as S

SCHEMA = StructType([StructField("id", LongType()), StructField("a", DoubleType()), StructField("b", DoubleType())])
RULES = (R.Rule("low_a", "a", "<", 2.0), R.Rule("low_b", "b", "<", 0.5))
SPEC = {"low_a": ("a", "b"), "low_b": ("b",)}

values = st.one_of(st.none(), st.just(float("nan")), st.just(-0.0), st.sampled_from([0.0, 0.25, 0.5, 1.0, 2.0, 3.5]))
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), values, values), max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", v + 0.0)  # -0.0 and 0.0 are one value
    return ("num", v)


def complete(r):
    return all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in r)


@SETTINGS
@given(rows)
def test_dedup_and_drop_incomplete_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = C.dedup(df).collect()
    assert len(got) == len({tuple(norm(v) for v in r) for r in data})
    kept = sorted(tuple(norm(v) for v in r) for r in C.drop_incomplete(df).collect())
    assert kept == sorted(tuple(norm(v) for v in r) for r in data if complete(r))


@SETTINGS
@given(rows)
def test_keyed_dedup_keeps_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = C.dedup(df, ["id"], ["a"]).collect()
    assert sorted(norm(r["id"]) for r in got) == sorted({norm(r[0]) for r in data})
    rows_by_key = {}
    for r in data:
        rows_by_key.setdefault(norm(r[0]), set()).add(tuple(norm(v) for v in r))
    for r in got:
        assert tuple(norm(v) for v in r) in rows_by_key[norm(r["id"])]


def hit(v, t):
    return v is not None and not math.isnan(v) and v < t


@SETTINGS
@given(rows)
def test_flags_routes_and_compare_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    flagged = R.flag(df, RULES).collect()
    assert sorted((r["low_a"], r["low_b"]) for r in flagged) == sorted(
        (int(hit(r[1], 2.0)), int(hit(r[2], 0.5))) for r in data
    )
    assert R.route_long(df, RULES).count() == sum(int(hit(r[1], 2.0)) + int(hit(r[2], 0.5)) for r in data)
    got = {(r["condition"], r["flag"], r["metric"]): (r["n"], r["mean"]) for r in S.compare(df, RULES, SPEC).collect()}
    for rule, idx, t in (("low_a", 1, 2.0), ("low_b", 2, 0.5)):
        for v in (0, 1):
            members = [r for r in data if int(hit(r[idx], t)) == v]
            for m, mi in (("a", 1), ("b", 2)):
                if m not in SPEC[rule]:
                    continue
                vals = [r[mi] for r in members if r[mi] is not None]
                n, mean = got[(rule, v, m)]
                assert n == len(members)
                if not vals:
                    assert mean is None
                elif any(math.isnan(x) for x in vals):
                    assert math.isnan(mean)
                else:
                    assert math.isclose(mean, sum(vals) / len(vals), rel_tol=1e-12, abs_tol=1e-12)
