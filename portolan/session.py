"""Session construction and the shared checkpoint / scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (bad input goes through the
# try_* forms explicitly), the session is pinned to UTC, and AQE re-plans
# joins / coalesces partitions / splits skewed partitions at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints are removed once their DataFrame is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, executor_memory_gb: float = 16.0,
                 cores_per_executor: int = 4, large_streaming_state: bool = False) -> dict:
    """Sizing for a run over ``input_bytes`` of parquet on ``total_cores``.

    * scan splits of 512 MB (fewer, larger tasks; parquet row groups are
      read whole), but never so large that a wave of tasks leaves cores idle;
    * an initial shuffle partition count sized on the shuffled volume (about
      a third of the input once columns are pruned and aggregates combined
      map-side) at ~256 MB per reduce partition -- one core's comfortable
      share of executor memory, so sorts and aggregations spill rarely --
      capped at 100k (map-status tracking on the driver grows with
      mappers x reducers); AQE coalesces small partitions and splits skewed
      ones;
    * the runtime broadcast limit scaled to executor memory (the build side
      is materialized once per executor);
    * RocksDB state for streaming jobs with large keyed state (e.g. the
      landing job's de-duplication); small rate tables do not need it.
    """
    split = max(64 * MB, min(512 * MB, input_bytes // max(total_cores * 2, 1)))
    shuffle_parts = min(100_000, max(total_cores * 2, int(input_bytes // 3 // (256 * MB))))
    per_core_mb = executor_memory_gb * 1024 / max(cores_per_executor, 1)
    conf = {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(int(min(256, per_core_mb / 8) * MB)),
    }
    if large_streaming_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return conf


def get_session(master: str | None = None, app: str = "portolan",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` wins.  Only when it is
    unset *and* the session is local (tests, laptops) do we create one
    under the system temp folder; on a cluster an unset value is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    local = tempfile.mkdtemp(prefix="portolan-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, streaming checkpoints and written
    intermediate tables (a sibling of the RDD checkpoint folder)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/portolan/{name}-{uuid.uuid4().hex[:12]}"


def path_status(spark: SparkSession, path: str) -> str:
    """``directory``, ``file`` or ``missing``, on any file system Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return "missing"
    return "directory" if fs.getFileStatus(p).isDirectory() else "file"
