"""Session construction and the shared scratch folder.

Jobs that cut lineage or write intermediate tables use the folder named by
``spark.checkpoint.dir``.  On a cluster that setting must point at shared
storage (HDFS / object store); a machine-local folder is only created when the
session runs in local mode and the setting is unset (tests, the bench).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce by the advisory partition size, not "at least default parallelism":
    # avoids hundreds of tiny tasks per stage on a busy cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster reading ~100 TB.  Shuffles start wide and AQE
# coalesces them to ~256 MB partitions, so no reducer holds more than it can
# sort / aggregate in memory; scan splits stay at 256 MB; tables are broadcast
# only when their measured size is under 64 MB (one row per patient of a
# multi-million-patient cohort is above that and shuffles instead).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app: str = "cohortlab", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with AQE (coalescing + skew-join splitting) switched on.

    ``cluster=True`` applies ``CLUSTER_CONF`` and leaves the master to
    spark-submit (pass ``master=None``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None and not cluster:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not cluster:
        conf.setdefault("spark.driver.memory", os.environ.get("COHORTLAB_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a cluster session without one is an error."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base:
        return base
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif sc.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        sc.setCheckpointDir(local)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running cohortlab jobs")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the shared checkpoint folder (eager).

    Used before iterative fits so that a lost executor re-reads the checkpoint
    instead of recomputing the whole upstream plan.  Like every job that needs the
    folder, it is an error on a cluster without ``spark.checkpoint.dir``.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    # persisted first, so writing the checkpoint files re-reads the cached rows
    # instead of running the plan a second time
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the session's checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only when
    neither is set *and* the session is local does it create one under the
    system temp folder; a cluster session without the setting is an error,
    because executors cannot see each other's local disks.
    """
    base = _ensure_checkpoint_dir(spark)
    leaf = f"{name or 'tmp'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + leaf


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared scratch folder and read back.

    Cuts the lineage and survives lost executors; later plans read it column-pruned.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
