"""Session helpers: shared folder resolution and cluster sizing."""

from alloy.session import HUGE_METHOD_LIMIT, cluster_conf, scratch_path, shared_root


def test_cluster_conf_sizes_partitions_to_the_input():
    conf = cluster_conf(100 * 1024**4)  # 100 TB
    assert int(conf["spark.sql.shuffle.partitions"]) == 204_800
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.codegen.hugeMethodLimit"] == HUGE_METHOD_LIMIT
    assert "spark.checkpoint.dir" not in conf  # left to the cluster
    assert int(cluster_conf(10 << 20)["spark.sql.shuffle.partitions"]) == 200


def test_shared_root_comes_from_the_session(spark):
    root = shared_root(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
