"""A key holding a third of all rows: the share join stays correct and AQE
splits the hot partition instead of giving it to one task."""

from pyspark.sql import functions as F

from portolan.operators.shares import share_of_total

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _skewed(spark, n=30000):
    # a third of the rows share one key; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 1000).cast("string")).alias("hs"),
        F.lit("202001").alias("period"),
        ((F.col("id") % 97) + 0.25).alias("v"))


def test_hot_key_split_and_results_match(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = _skewed(spark)
        # beyond the broadcast bound: sort-merge join, hot partition split by AQE
        joined = share_of_total(df, "v", ["period", "hs"], "t", "s", strategy="join",
                                broadcast_max_rows=None)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
        windowed = share_of_total(df, "v", ["period", "hs"], "t", "s", strategy="window")
        key = lambda r: (r.hs, r.v, r.t, r.s)
        assert sorted(map(key, rows)) == sorted(map(key, windowed.collect()))
        hot = [r for r in rows if r.hs == "HOT"]
        assert len(hot) == 10000 and abs(sum(r.s for r in hot) - 1.0) < 1e-9
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_join_strategy_broadcasts_checkpointed_totals(spark):
    df = _skewed(spark, 3000)
    out = share_of_total(df, "v", ["period", "hs"], "t", "s", strategy="join")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan  # the rows are never shuffled


def test_salted_totals_spread_a_hot_group_and_read_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    # copies of one row are a third of all; some keys are null
    df = _skewed(spark).union(spark.range(15000).select(F.lit("HOT"), F.lit("202001"), F.lit(5.5)))
    df = df.union(spark.range(50).select(F.lit(None).cast("string"), F.lit("202001"), F.lit(1.25)))
    df.repartition(8).write.parquet(path)
    table = spark.read.parquet(path)
    jobs = _jobs(spark, lambda: share_of_total(table, "v", ["period", "hs"], "t", "s"))
    salted = share_of_total(table, "v", ["period", "hs"], "t", "s")
    rows = salted.collect()
    assert jobs == []  # nothing runs while the plan is built
    plan = salted._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    windowed = share_of_total(table, "v", ["period", "hs"], "t", "s", strategy="window")
    key = lambda r: (r.hs or "", r.v, round(r.t, 6), round(r.s, 12))
    assert sorted(map(key, rows)) == sorted(map(key, windowed.collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (salted.filter("hs = 'HOT'").groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 25000 * 0.7


def _jobs(spark, build):
    sc = spark.sparkContext
    sc.setJobGroup("definition", "definition only")
    try:
        build()
        return list(sc.statusTracker().getJobIdsForGroup("definition"))
    finally:
        sc.setJobGroup(None, None)
