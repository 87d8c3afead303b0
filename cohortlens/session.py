"""Spark session and checkpoint-directory helpers.

Library code never hard-codes a scratch path: lineage is cut into the shared
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent (tests, a laptop) do we fall back to a directory the caller gives us.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "cohortlens", extra: dict | None = None) -> SparkSession:
    """Session tuned for the workloads in this package.

    AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
    and splits skewed ones; the UI stays off (no server/port). Pass
    ``master=None`` (and ``shuffle_partitions=None``) under spark-submit so
    the cluster's own settings are kept."""
    b = SparkSession.builder
    if master is not None:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (
        b.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run (pass as ``extra`` to ``build_session``
    or to ``spark-submit --conf``).

    Scan splits and shuffle partitions are sized so one task handles about
    ``target_partition_bytes`` (fits executor memory with room to spill);
    the shuffle partition count is at least 3 waves of the total cores so AQE
    can coalesce small partitions and split skewed ones. Joins broadcast a
    side only after AQE has measured it below 64 MB; explicit broadcasts in
    this package are bounded by construction (one-row aggregates, per-class
    tables, one row per range of 100,000 distinct scores)."""
    cores = max(1, executors * cores_per_executor)
    shuffle = max(3 * cores, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # broadcast only from measured runtime sizes (AQE), never from
        # planner estimates of a side whose real size is unknown
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The checkpoint folder of this session, registered with the context.

    A folder already set on the context wins; then ``spark.checkpoint.dir``
    as read from the session; then the explicit ``folder``. With none of them
    a local master (tests, one machine) uses a folder inside the session's
    warehouse, and a cluster is an error: its executors need a shared folder.
    The session's configuration is only read, never changed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get(CHECKPOINT_CONF, None) or folder
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
