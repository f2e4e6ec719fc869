from portolan.session import MB, checkpoint_root, cluster_conf


def test_cluster_conf_scales_with_input():
    tb100 = cluster_conf(100 * (1 << 40), total_cores=8000)
    assert int(tb100["spark.sql.files.maxPartitionBytes"]) == 512 * MB
    assert int(tb100["spark.sql.shuffle.partitions"]) == 100_000
    small = cluster_conf(200 * MB, total_cores=8)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 64 * MB
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert "spark.sql.streaming.stateStore.providerClass" in cluster_conf(1, 1, large_streaming_state=True)


def test_checkpoint_root_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root and root == (spark.conf.get("spark.checkpoint.dir", None) or root)
