"""Features, key-based split, forest training, evaluation and the promotion gate."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)
from pyspark.errors import AnalysisException
from pyspark import StorageLevel

from alloy.functions.columns import interaction, mean_of, ratio

# Feature columns of the laboratory model, in the original order.
LAB_FEATURES = (
    "volume_ml",
    "ph",
    "motility_progressive",
    "motility_non_progressive",
    "vitality",
    "head_defects",
    "midpiece_defects",
    "tail_defects",
    "motility_ratio",
    "motility_vitality_interaction",
    "defect_ratio",
    "health_index",
)


def lab_features(df: DataFrame) -> DataFrame:
    """Derived model inputs of the laboratory table, in one projection."""
    total = F.col("motility_progressive") + F.col("motility_non_progressive")
    return df.withColumns(
        {
            "total_motility": total,
            "motility_ratio": ratio("motility_progressive", total),
            "motility_vitality_interaction": interaction("motility_progressive", "vitality"),
            "defect_ratio": mean_of(["head_defects", "midpiece_defects", "tail_defects"]),
            "health_index": mean_of(["vitality", "motility_progressive", "normal_forms"]),
        }
    )


ROWS_PER_TASK = 25_000  # training rows that one task bins
MAX_TRAIN_ROWS = 20_000_000  # a forest keeps one count per tree for every row it is fit on


def _cut(train_pct: int, buckets: int) -> int:
    if train_pct * buckets % 100:
        raise ValueError(f"{train_pct} % of {buckets} buckets is not a whole number of buckets")
    return train_pct * buckets // 100


def hash_bucket(keys: Sequence[str], buckets: int = 100) -> Column:
    """Stable bucket of a row from its key columns only."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))


def split_side(bucket: Column, train_pct: int = 70, buckets: int = 100) -> Column:
    """``"train"`` / ``"test"`` label of a row from its key bucket (the same
    cut as ``hash_split``), for one-scan summaries of both sides."""
    return F.when(bucket < F.lit(_cut(train_pct, buckets)), F.lit("train")).otherwise(F.lit("test"))


def hash_split(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    train_pct: int = 70,
    buckets: int = 100,
    bucket: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: a row's side never changes between runs,
    retries or partitionings, and duplicates of a key stay on one side.
    Both sides are plain filters of one scan (no sampling, no shuffle).
    A custom ``bucket`` column must take values in ``[0, buckets)``. A cut
    that does not fall between two buckets is refused."""
    b = bucket if bucket is not None else hash_bucket(keys or df.columns, buckets)
    cut = F.lit(_cut(train_pct, buckets))
    return df.filter(b < cut), df.filter(b >= cut)


def train(
    train_df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    trees: int = 100,
    depth: int = 6,
    seed: int = 42,
    max_train_rows: int = MAX_TRAIN_ROWS,
    partitions: int | None = None,
) -> PipelineModel:
    """Assemble, scale to unit sample std without centring, random forest.

    The forest keeps every training row with one bagging count per tree for
    its passes, so it is fit on at most about ``max_train_rows`` rows; beyond
    that, rows are chosen by a hash of their values. The chosen rows are dealt
    over ``partitions`` tasks (by default one per ``ROWS_PER_TASK`` rows,
    whatever the cluster's size, since bagging depends on the partitions) and
    kept for the fit's passes only.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_vec")
    scaler = StandardScaler(inputCol="features_vec", outputCol="features", withMean=False, withStd=True)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    pipeline = Pipeline(stages=[assembler, scaler, forest])
    narrow = train_df.select(*features, label)
    rows = narrow.count()
    if rows > max_train_rows:
        rank = F.pmod(F.xxhash64(*narrow.columns, F.lit(seed)), F.lit(1 << 30))
        narrow = narrow.filter(rank < F.lit(int(max_train_rows / rows * (1 << 30))))
        rows = max_train_rows
    wide = narrow.repartition(partitions or max(1, -(-rows // ROWS_PER_TASK)))
    wide = wide.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(wide)
    finally:
        wide.unpersist()


def evaluate(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row (per value of ``by``): f1 (support-weighted), accuracy, n.

    The confusion matrix is aggregated first (partial aggregation per task,
    at most classes^2 rows after), then per-class precision / recall are
    folded. A class never predicted scores precision 0, as in MLlib. With
    ``weight`` each input row counts that many times (a pre-counted cube).
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    cnt = F.sum(F.col(weight)).cast("bigint") if weight else F.count(F.lit(1))
    conf = pred.groupBy(*by, y.alias("y"), p.alias("p")).agg(cnt.alias("cnt"))
    hit = F.when(F.col("y") == F.col("p"), F.col("cnt")).otherwise(F.lit(0))
    contrib = conf.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("y").alias("cls"), F.col("cnt").alias("support"),
                         F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
                F.struct(F.col("p").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                         F.col("cnt").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
            )
        )
    )
    per = contrib.groupBy(*by, "cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    f1 = F.when(prec + rec == 0, F.lit(0.0)).otherwise(F.lit(2.0) * prec * rec / (prec + rec))
    per = per.withColumn("f1", f1)
    n = F.sum("support")
    return per.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("f1") * F.col("support")), n.cast("double")).alias("f1"),
        F.try_divide(F.sum("tp").cast("double"), n.cast("double")).alias("accuracy"),
        n.cast("bigint").alias("n"),
    )


def evaluate_pair(pred: DataFrame, label: str, first: str, second: str) -> tuple:
    """Scores of two prediction columns from ONE pass over ``pred``.

    The rows are counted per (label, first, second); each count then stands
    for both columns and the two confusion matrices are folded side by side.
    Returns two rows (f1, accuracy, n).
    """
    cube = pred.groupBy(
        F.col(label).cast("double").alias("y"),
        F.col(first).cast("double").alias("p1"),
        F.col(second).cast("double").alias("p2"),
    ).agg(F.count(F.lit(1)).alias("w"))
    both = F.array(*(F.struct(F.lit(i).alias("which"), F.col(p).alias("p")) for i, p in ((1, "p1"), (2, "p2"))))
    cells = cube.select("y", "w", F.inline(both))
    scores = {r["which"]: r for r in evaluate(cells, "y", "p", weight="w", by=["which"]).collect()}
    empty = Row(f1=None, accuracy=None, n=0)
    return scores.get(1, empty), scores.get(2, empty)


def evaluate_mllib(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> tuple[float, float]:
    """The same two scores through MLlib's evaluator (two scalar actions)."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction)
    return (
        ev.setMetricName("f1").evaluate(pred),
        ev.setMetricName("accuracy").evaluate(pred),
    )


PROMOTION_SCHEMA = StructType(
    [
        StructField("run_id", StringType(), False),
        StructField("model_path", StringType(), False),
        StructField("f1", DoubleType(), True),
        StructField("accuracy", DoubleType(), True),
        StructField("promoted_at", TimestampType(), False),
    ]
)

GATE_SCHEMA = StructType(
    [
        StructField("run_id", StringType(), False),
        StructField("promoted", BooleanType(), False),
        StructField("challenger_f1", DoubleType(), True),
        StructField("champion_f1", DoubleType(), True),
        StructField("challenger_accuracy", DoubleType(), True),
        StructField("champion_accuracy", DoubleType(), True),
        StructField("n_test", LongType(), True),
    ]
)


def _is_missing_path(e: AnalysisException) -> bool:
    cond = None
    for attr in ("getCondition", "getErrorClass"):
        fn = getattr(e, attr, None)
        if fn is not None:
            cond = fn()
            if cond:
                break
    return cond == "PATH_NOT_FOUND"


def current_champion(spark: SparkSession, registry: str) -> tuple[str, str] | None:
    """(run_id, model_path) of the latest promotion, None when nothing was ever
    promoted. Only a missing registry counts as "no champion"; any other
    failure (corrupt log, permissions) is raised."""
    try:
        log = spark.read.schema(PROMOTION_SCHEMA).parquet(f"{registry}/promotions")
    except AnalysisException as e:
        if _is_missing_path(e):
            return None
        raise
    last = log.orderBy(F.col("promoted_at").desc(), F.col("run_id").desc()).select("run_id", "model_path").take(1)
    return (last[0]["run_id"], last[0]["model_path"]) if last else None


def gate(
    spark: SparkSession,
    challenger: PipelineModel,
    registry: str,
    test: DataFrame,
    run_id: str,
    label: str = "label",
    partitions: int | None = None,
) -> DataFrame:
    """Promote the challenger if there is no champion or its weighted F1 is
    strictly greater on the same test rows (a tie keeps the champion).

    Every attempt is written to a folder of its own, also when a run id
    repeats, and promotion is an append to a small log, so the old champion is
    never deleted or overwritten; a failed write leaves the previous champion
    in force. ``partitions`` deals the test rows (the model's inputs and the
    label only) over that many tasks before scoring; unset, they stay in the
    splits they come in. Returns one row (GATE_SCHEMA).
    """
    # The candidate is written first and scored from its stored copy: the
    # stored model is exactly what a promotion would serve, and a freshly fit
    # forest carries a training summary bound to the session, which cannot be
    # shipped to executors once the session has used an Observation.
    path = f"{registry}/models/{run_id}/{uuid.uuid4().hex}"
    challenger.write().save(path)
    stored = PipelineModel.load(path)
    champ = current_champion(spark, registry)
    champion = PipelineModel.load(champ[1]) if champ else None
    inputs = {c for m in (stored, champion) if m is not None for c in m.stages[0].getInputCols()}
    scored = test.select(*sorted(inputs), label)
    if partitions:
        scored = scored.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # score the challenger, keep only its prediction, then let the champion
        # score the same rows: both are evaluated from a single pass
        out = stored.transform(scored)
        extra = [c for c in out.columns if c not in scored.columns and c != "prediction"]
        frame = out.drop(*extra).withColumnRenamed("prediction", "_challenger")
        champ_f1 = champ_acc = None
        if champion is None:
            ch = evaluate(frame, label, "_challenger").first()
        else:
            frame = champion.transform(frame).withColumnRenamed("prediction", "_champion")
            ch, cp = evaluate_pair(frame, label, "_challenger", "_champion")
            champ_f1, champ_acc = cp["f1"], cp["accuracy"]
    finally:
        if partitions:
            scored.unpersist()
    promote = champ is None or (ch["f1"] is not None and champ_f1 is not None and ch["f1"] > champ_f1)
    if promote:
        entry = [(run_id, path, ch["f1"], ch["accuracy"], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
        spark.createDataFrame(entry, PROMOTION_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{registry}/promotions"
        )
    result = [(run_id, bool(promote), ch["f1"], champ_f1, ch["accuracy"], champ_acc, ch["n"])]
    return spark.createDataFrame(result, GATE_SCHEMA)
