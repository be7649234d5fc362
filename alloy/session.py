"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Whole-stage codegen emits one Java method per stage. HotSpot does not JIT
# methods above 8000 bytes of bytecode, so a wide stage (the keyed generator
# with a pushed-down completeness filter) would run interpreted, ~5x slower.
# At this limit Spark falls back to per-operator codegen for such a stage,
# whose methods are split small enough to compile.
HUGE_METHOD_LIMIT = "8000"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "alloy",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ALLOY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT)
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts, layers and stream state.

    Read from the session (``spark.checkpoint.dir`` or a checkpoint dir set on
    the context). When neither is set, a local session gets a fresh temporary
    folder, registered as its checkpoint dir; on a cluster that is an error,
    because executors could not see one machine's folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = sc.getCheckpointDir()
        if existing:
            root = existing
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="alloy-work-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the application's scratch folder, unique per call."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/alloy/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything this application wrote under ``scratch_path``.

    Results that are still read lazily from there must have been used. Goes
    through Spark's own file system layer, so it works on any shared store.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster_conf(input_bytes: int, target_partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Settings sized for a large cluster run over ``input_bytes`` of input.

    * Scan splits and shuffle partitions target ~``target_partition_bytes``
      (512 MB by default: 100 TB gives ~200k scan tasks and as many initial
      shuffle partitions, which AQE coalesces when the data shrinks, e.g.
      after map-side dedup or the one-row statistics aggregate).
    * Concurrent output writers let the routed gold write (``partitionBy``
      on a handful of conditions) skip the per-task sort.
    * Stages whose generated method would be too large to JIT fall back to
      per-operator codegen (``HUGE_METHOD_LIMIT``).
    ``spark.checkpoint.dir`` is expected to be set by the cluster (shared
    storage) and is deliberately not set here.
    """
    parts = max(200, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.codegen.hugeMethodLimit": HUGE_METHOD_LIMIT,
    }
