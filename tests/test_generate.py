
import pytest
from pyspark.sql import functions as F

from alloy.operators import rules as R
from alloy.operators import stats as S
from alloy.sources.generate import LAB_RULES, measurements
from alloy.sources.layers import BRONZE_SCHEMA

# Expected flag rates of the keyed generator on 2,000,000 rows (fixed values).
EXPECTED = {
    "oligospermia": 0.0346,
    "asthenozoospermia": 0.4719,
    "teratozoospermia": 0.5718,
    "necrospermia": 0.2995,
    "hypospermia": 0.0227,
}
EXPECTED_LABEL = 0.1495


@pytest.fixture(scope="module")
def bronze(spark):
    return measurements(spark, 200_000, partitions=8)


def test_schema_matches_bronze(bronze):
    assert bronze.schema == BRONZE_SCHEMA or [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE_SCHEMA]
    assert bronze.columns == [f.name for f in BRONZE_SCHEMA]


def test_ranges_and_motility_sum(bronze):
    total = F.col("motility_progressive") + F.col("motility_non_progressive") + F.col("motility_immotile")
    r = bronze.agg(
        F.min("volume_ml"), F.max("volume_ml"), F.min("concentration"), F.max("concentration"),
        F.min("ph"), F.max("ph"), F.min(total), F.max(total), F.min("vitality"), F.max("vitality"),
        F.min("normal_forms"), F.max("normal_forms"), F.count_if(F.col("sample_id").isNull()),
    ).first()
    assert 1.3 <= r[0] and r[1] <= 10.0
    assert 3 <= r[2] and r[3] <= 349
    assert 7.0 <= r[4] and r[5] <= 8.0
    assert 99.8 <= r[6] and r[7] <= 100.2
    assert 40.0 <= r[8] and r[9] <= 100.0
    assert 0.0 <= r[10] and r[11] <= 12.9  # 14.3% * 92.7% * 97.5% at the best extremes
    assert r[12] == 0


def test_reproducible_under_any_partitioning(spark):
    a = measurements(spark, 5000, partitions=1).orderBy("sample_id").collect()
    b = measurements(spark, 5000, partitions=7).orderBy("sample_id").collect()
    assert a == b
    c = measurements(spark, 5000, seed=3).orderBy("sample_id").collect()
    assert a != c


def test_flag_rates_within_tolerance(bronze):
    prev = {r["condition"]: r["rate"] for r in S.prevalence(bronze, LAB_RULES).collect()}
    for name, rate in EXPECTED.items():
        assert abs(prev[name] - rate) <= 0.005, (name, prev[name])
    label = R.all_pass_label(bronze, LAB_RULES).agg(F.avg("label")).first()[0]
    assert abs(label - EXPECTED_LABEL) <= 0.005


def test_label_iff_no_flag_and_route_sizes(bronze):
    df = R.all_pass_label(R.flag(bronze, LAB_RULES), LAB_RULES)
    total = sum((F.col(r.name) for r in LAB_RULES[1:]), F.col(LAB_RULES[0].name))
    bad = df.filter((F.col("label") == 1) != (total == 0)).count()
    assert bad == 0
    routed = R.route_long(df, LAB_RULES)
    assert routed.count() == df.agg(F.sum(total)).first()[0]
    per_route = {r["condition"]: r["count"] for r in routed.groupBy("condition").count().collect()}
    prev = {r["condition"]: r["n"] for r in S.prevalence(df, LAB_RULES).collect()}
    assert per_route == prev


# Expected flag rates of the uniform generator on 2,000,000 rows (fixed values).
EXPECTED_UNIFORM = {
    "oligospermia": 0.0324,
    "asthenozoospermia": 0.4693,
    "teratozoospermia": 0.5720,
    "necrospermia": 0.2997,
    "hypospermia": 0.0171,
}
EXPECTED_UNIFORM_LABEL = 0.1509


def test_uniform_generator_distribution(spark):
    from alloy.sources.generate import measurements_uniform

    df = measurements_uniform(spark, 200_000, seed=5, partitions=8)
    assert df.columns == [f.name for f in BRONZE_SCHEMA]
    assert [f.dataType for f in df.schema] == [f.dataType for f in BRONZE_SCHEMA]
    prev = {r["condition"]: r["rate"] for r in S.prevalence(df, LAB_RULES).collect()}
    for name, rate in EXPECTED_UNIFORM.items():
        assert abs(prev[name] - rate) <= 0.005, (name, prev[name])
    label = R.all_pass_label(df, LAB_RULES).agg(F.avg("label")).first()[0]
    assert abs(label - EXPECTED_UNIFORM_LABEL) <= 0.005
    total = F.col("motility_progressive") + F.col("motility_non_progressive") + F.col("motility_immotile")
    lo, hi, cmin, cmax = df.agg(F.min(total), F.max(total), F.min("concentration"), F.max("concentration")).first()
    assert 99.85 <= lo and hi <= 100.15 and 3 <= cmin and cmax <= 349
    again = measurements_uniform(spark, 2000, seed=5, partitions=8).collect()
    assert again == measurements_uniform(spark, 2000, seed=5, partitions=8).collect()


def test_display_names(spark):
    from alloy.sources.generate import with_display_names

    df = with_display_names(R.flag(measurements(spark, 10), LAB_RULES))
    assert "Sperm concentration (x10⁶/mL)" in df.columns and "Oligospermia" in df.columns
    assert "sample_id" in df.columns
    bare = with_display_names(measurements(spark, 10), keep_key=False)
    assert len(bare.columns) == 12 and "sample_id" not in bare.columns and bare.columns[0] == "Ejaculate volume (mL)"
