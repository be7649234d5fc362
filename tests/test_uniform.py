"""Counter-based uniform generator: any key, any seed, no repeats, the original's rates."""

import pytest
from pyspark.sql import functions as F

from alloy.operators import rules as R
from alloy.operators import stats as S
from alloy.plans import catalog
from alloy.sources.generate import LAB_RULES, UNIFORM_RANGES
from alloy.sources.layers import BRONZE_SCHEMA
from alloy.sources.uniform import measurements_uniform_for

# Flag rates of the original's distributions on 2,000,000 rows (fixed values).
EXPECTED = {"oligospermia": 0.0324, "asthenozoospermia": 0.4693, "teratozoospermia": 0.5720, "necrospermia": 0.2997, "hypospermia": 0.0171}
MEASURES = [f.name for f in BRONZE_SCHEMA.fields[1:]]


@pytest.fixture(scope="module")
def rows(spark):
    return measurements_uniform_for(spark.range(1, 200_001, numPartitions=8).withColumnRenamed("id", "k"), "k").cache()


def test_schema_and_ranges(rows):
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    for c, (low, high) in UNIFORM_RANGES.items():
        least, most = rows.agg(F.min(c), F.max(c)).first()
        assert low - 1 < least <= low + 0.1 * (high - low) and high - 0.1 * (high - low) <= most <= high


def test_flag_rates(rows):
    got = {r["condition"]: r["rate"] for r in S.prevalence(rows, LAB_RULES).collect()}
    for name, rate in EXPECTED.items():
        assert abs(got[name] - rate) <= 0.006, (name, got[name])
    assert abs(R.all_pass_label(rows, LAB_RULES).agg(F.avg("label")).first()[0] - 0.1509) <= 0.006


def test_keys_at_both_ends_of_a_bigint(spark):
    ends = [0, 1, -1, 2**31 - 1, 2**31, -(2**31), 2**62, 2**63 - 1, -(2**63), 10**13 + 1]
    got = measurements_uniform_for(spark.createDataFrame([(k,) for k in ends], "k long"), "k").collect()
    assert [r["sample_id"] for r in got] == ends
    assert len({tuple(r)[1:] for r in got}) == len(ends)


def test_seeds_and_neighbours_are_unrelated(spark, rows):
    keys = spark.range(1, 50_001).withColumnRenamed("id", "k")
    other = measurements_uniform_for(keys, "k", seed=1)
    both = rows.alias("a").join(other.alias("b"), "sample_id")
    for c in ("volume_ml", "ph", "vitality", "tail_defects"):
        assert abs(both.agg(F.corr(f"a.{c}", f"b.{c}")).first()[0]) < 0.03
    # no row of one seed stands anywhere in the other: no shifted repeats
    assert rows.join(other, MEASURES, "left_semi").count() == 0
    near = rows.select((F.col("sample_id") + 1).alias("sample_id"), F.col("vitality").alias("before"))
    assert abs(rows.join(near, "sample_id").agg(F.corr("vitality", "before")).first()[0]) < 0.02
    assert rows.select(*MEASURES).distinct().count() == rows.count()


def test_columns_are_unrelated(rows):
    pairs = [("volume_ml", "ph"), ("concentration", "vitality"), ("head_defects", "tail_defects"), ("ph", "midpiece_defects")]
    got = rows.agg(*(F.corr(a, b) for a, b in pairs)).first()
    assert all(abs(x) < 0.02 for x in got)


def test_null_keys_and_empty_tables(spark):
    got = measurements_uniform_for(spark.createDataFrame([(None,), (5,), (5,)], "k long"), "k").collect()
    nulls = [r for r in got if r["sample_id"] is None]
    assert len(nulls) == 1 and all(x is None for x in nulls[0])
    assert len({tuple(r) for r in got if r["sample_id"] == 5}) == 1
    assert measurements_uniform_for(spark.createDataFrame([], "k long"), "k").count() == 0


def test_wide_keys_beyond_a_bigint_wrap(spark, tmp_dir):
    keys = [(0, 1), (0, 2), (76_861, 3), (76_861, 4), (149_999, 6), (149_999, 7), (9_000_000, 1), (10**15, 2), (None, 1)]
    spark.createDataFrame(keys, "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_dir}/wide/lineitem.parquet")
    got = catalog.QUERIES["uniform_bronze_seeded"](spark, f"{tmp_dir}/wide").collect()
    samples = [None if o is None else o * 8 + n for o, n in keys]
    exact = [None if k is None else k * 15 * 10**12 * (1 if k % 2 else -1) for k in samples]
    wrapped = [None if x is None else (x + 2**63) % 2**64 - 2**63 for x in exact]
    assert sum(x is not None and x != w for x, w in zip(exact, wrapped)) == 5
    assert sorted(map(str, (r["sample_id"] for r in got))) == sorted(map(str, wrapped))
    direct = measurements_uniform_for(spark.createDataFrame([(w,) for w in wrapped], "k long"), "k", seed=catalog.SECOND_SEED)
    assert sorted(map(str, direct.collect())) == sorted(map(str, got))
