"""Hot keys: one key holding a third of all rows must not cross the shuffle as
a third of all rows. The executed plan's exchange metrics are read after the
query runs."""

from pyspark.sql import functions as F

from alloy.operators import clean as C
from alloy.operators import stats as S
from alloy.operators import rules as R

MAPS = 6


def shuffle_records(df) -> int:
    """Sum of ``shuffleRecordsWritten`` over the exchanges of the executed plan.

    ``collect`` runs the frame's own query execution (a write would plan a
    new one), so its plan carries the metrics afterwards. Fixtures are small.
    """
    df.collect()
    qe = df._jdf.queryExecution()
    root = qe.executedPlan()
    total = 0
    stack = [root]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):  # result / shuffle stages wrap their plan
            stack.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                total += int(metric.get().value())
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def skewed(spark, n=30_000):
    # key 0 holds a third of the rows; the rest are distinct keys
    base = spark.range(0, n, numPartitions=MAPS)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return base.select(key.alias("k"), (F.col("id") % 7).cast("double").alias("v"))


def test_keyed_dedup_hot_key_is_combined_map_side(spark):
    df = skewed(spark)
    n_distinct = df.select("k").distinct().count()
    out = C.dedup(df, ["k"], ["v"])
    # each map task emits at most one row per key it saw
    assert shuffle_records(out) <= n_distinct - 1 + MAPS
    assert out.count() == n_distinct
    assert out.filter("k = 0").first()["v"] == 0.0


def test_whole_row_dedup_hot_row_is_combined_map_side(spark):
    base = spark.range(0, 30_000, numPartitions=MAPS)
    hot = base.select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    out = C.dedup(hot)
    distinct = out.count()
    assert shuffle_records(out) <= distinct - 1 + MAPS


def test_statistics_shuffle_one_row_per_map_task(spark):
    df = skewed(spark)
    rules = (R.Rule("low_v", "v", "<", 3.0),)
    out = S.compare(df, rules, {"low_v": ("v", "k")})
    assert shuffle_records(out) <= MAPS


def test_metric_reader_sees_a_plain_shuffle(spark):
    # guards the helper itself: a repartition moves every row
    assert shuffle_records(skewed(spark).repartition(4, "k")) == 30_000
