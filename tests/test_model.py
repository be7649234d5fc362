"""Split, evaluation and the promotion gate state machine."""

import math

import pytest
from pyspark.sql import functions as F

from alloy.operators import model as M
from alloy.operators import rules as R
from alloy.sources.generate import LAB_RULES, measurements


@pytest.fixture(scope="module")
def frame(spark):
    df = R.all_pass_label(M.lab_features(measurements(spark, 4000, partitions=4)), LAB_RULES)
    return df.persist()


def test_hash_split_disjoint_complete_stable(frame):
    train, test = M.hash_split(frame, ["sample_id"], 70)
    ids_train = {r[0] for r in train.select("sample_id").collect()}
    ids_test = {r[0] for r in test.select("sample_id").collect()}
    assert not ids_train & ids_test
    assert len(ids_train) + len(ids_test) == frame.count()
    again, _ = M.hash_split(frame.repartition(11), ["sample_id"], 70)
    assert {r[0] for r in again.select("sample_id").collect()} == ids_train
    assert 0.65 < len(ids_train) / frame.count() < 0.75


def test_evaluate_matches_mllib(spark, frame):
    pred = frame.withColumn("prediction", F.when(F.col("vitality") >= 58, 1.0).otherwise(0.0))
    ours = M.evaluate(pred).first()
    f1, acc = M.evaluate_mllib(pred)
    assert math.isclose(ours["f1"], f1, rel_tol=1e-12) and math.isclose(ours["accuracy"], acc, rel_tol=1e-12)
    # a class that is never predicted scores 0 (no division error)
    const = frame.withColumn("prediction", F.lit(0.0))
    f1c, accc = M.evaluate_mllib(const)
    ours_c = M.evaluate(const).first()
    assert math.isclose(ours_c["f1"], f1c, rel_tol=1e-12) and math.isclose(ours_c["accuracy"], accc, rel_tol=1e-12)


def test_gate_state_machine(spark, frame, tmp_dir):
    train, test = M.hash_split(frame, ["sample_id"], 70)
    good = M.train(train, M.LAB_FEATURES, trees=5, depth=4, seed=1)
    weak = M.train(train, ["ph"], trees=2, depth=1, seed=1)
    reg = f"{tmp_dir}/registry"
    assert M.current_champion(spark, reg) is None
    # absent -> promote (even a weak model)
    r = M.gate(spark, weak, reg, test, "r1").first()
    assert r["promoted"] and r["champion_f1"] is None
    # better -> promote
    r = M.gate(spark, good, reg, test, "r2").first()
    assert r["promoted"] and r["challenger_f1"] > r["champion_f1"]
    assert M.current_champion(spark, reg)[0] == "r2"
    # tie -> keep
    r = M.gate(spark, good, reg, test, "r3").first()
    assert not r["promoted"] and r["challenger_f1"] == r["champion_f1"]
    # worse -> keep
    r = M.gate(spark, weak, reg, test, "r4").first()
    assert not r["promoted"] and r["challenger_f1"] < r["champion_f1"]
    assert M.current_champion(spark, reg)[0] == "r2"


def test_gate_raises_on_corrupt_champion(spark, frame, tmp_dir):
    train, test = M.hash_split(frame, ["sample_id"], 70)
    model = M.train(train, ["ph", "vitality"], trees=2, depth=2, seed=1)
    reg = f"{tmp_dir}/registry"
    M.gate(spark, model, reg, test, "first")
    # point the log at a champion folder that holds no model
    bogus = spark.createDataFrame(
        [("bogus", f"{tmp_dir}/nothing-here", 0.5, 0.5, __import__("datetime").datetime(2999, 1, 1))], M.PROMOTION_SCHEMA
    )
    bogus.write.mode("append").parquet(f"{reg}/promotions")
    with pytest.raises(Exception):
        M.gate(spark, model, reg, test, "second")


def test_evaluate_pair_matches_separate_evaluations(frame):
    pred = frame.withColumns(
        {
            "p1": F.when(F.col("vitality") >= 58, 1.0).otherwise(0.0),
            "p2": F.when(F.col("ph") >= 7.5, 1.0).otherwise(0.0),
        }
    )
    a, b = M.evaluate_pair(pred, "label", "p1", "p2")
    ea, eb = M.evaluate(pred, "label", "p1").first(), M.evaluate(pred, "label", "p2").first()
    for got, exp in ((a, ea), (b, eb)):
        assert got["n"] == exp["n"]
        assert math.isclose(got["f1"], exp["f1"], rel_tol=1e-12) and math.isclose(got["accuracy"], exp["accuracy"], rel_tol=1e-12)


def test_repeated_run_id_leaves_the_champion(spark, frame, tmp_dir):
    train, test = M.hash_split(frame, ["sample_id"], 70)
    good = M.train(train, M.LAB_FEATURES, trees=5, depth=4, seed=1)
    weak = M.train(train, ["ph"], trees=2, depth=1, seed=1)
    reg = f"{tmp_dir}/same-id"
    first = M.gate(spark, good, reg, test, "day-1").first()
    path = M.current_champion(spark, reg)[1]
    again = M.gate(spark, weak, reg, test, "day-1").first()
    assert not again["promoted"] and again["champion_f1"] == first["challenger_f1"]
    assert M.current_champion(spark, reg)[1] == path


def test_split_cuts_between_buckets_only():
    for call in (lambda: M.split_side(F.lit(1), 75, 10), lambda: M.hash_split(None, ["a"], 75, 10, bucket=F.lit(1))):
        with pytest.raises(ValueError):
            call()


def test_training_rows_are_bounded(frame):
    model = M.train(frame, ["ph", "vitality"], trees=2, depth=2, seed=1, max_train_rows=200)
    assert model.stages[-1].numFeatures == 2
