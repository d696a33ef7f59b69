"""Session helpers: lineage cutting and the cluster profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.session import CLUSTER_CONF, cut_lineage, scratch_dir


def test_cut_lineage_keeps_rows_and_drops_the_plan(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    cut = cut_lineage(df)
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Range" not in plan  # reads the checkpoint, not the upstream job


def test_scratch_dirs_are_fresh_and_under_the_checkpoint_folder(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    base = spark.sparkContext.getCheckpointDir()
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_cluster_profile_sizes():
    assert int(CLUSTER_CONF["spark.sql.autoBroadcastJoinThreshold"]) == 64 * 1024 * 1024
    assert int(CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 * 1024 * 1024
    assert int(CLUSTER_CONF["spark.sql.shuffle.partitions"]) >= 10000
