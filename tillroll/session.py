"""Session helpers: the shared work folder and a local session for tests/bench.

Library code never creates a session of its own; every public function takes
DataFrames (or a ``SparkSession``) from the caller.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_ROOT_NAME = "tillroll"
# What a task reads of compressed files at most, unless the session was given another
# size. Rows of order lines take over ten times as much in the sort of a keep-first
# group-by as in their files; Spark's 128 MB would be sorted by spilling.
SPLIT_BYTES = 16 << 20
_SPLITS = "spark.sql.files.maxPartitionBytes"
# Likewise of a shuffle: 64 MB of sorted keys are some ten million, more than an
# aggregate's hash map holds in a task's memory.
_COALESCED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and written tables.

    Read from ``spark.checkpoint.dir``. A session without one gets a temporary
    folder only if its master is local; on a cluster that folder would be the
    driver's alone, so this raises there.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(local)
    return local


def work_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{_ROOT_NAME}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for rows that a query lands on their way, under one that is this
    application's own."""
    return f"{work_root(spark)}/scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what queries of this application landed; call it when their results, which
    read from there, have been stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/scratch/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # independent jobs (six feeds, four dimensions, model-test units) are
        # submitted from threads; FAIR shares the cores between them
        .config("spark.scheduler.mode", "FAIR")
        # dense_key's reliable checkpoint is as large as the table it numbers:
        # delete checkpoint files once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Session settings every job of the pipeline relies on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    for size in (_SPLITS, _COALESCED):
        if spark.conf.get(size, None) is None:
            spark.conf.set(size, str(SPLIT_BYTES))
