"""Session and shared-storage helpers.

Library code never builds its own session; callers pass one in.  These
helpers exist for tests, the bench and the driver entry point, plus the
one place that decides where intermediate data may be written: the
cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for the container (local mode); on a cluster the
# submitter's configuration wins because ``getOrCreate`` keeps it.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Settings for a large cluster (hundreds of executors, ~100 TB inputs).
# AQE starts from many shuffle partitions and coalesces them to about the
# advisory size, so no per-query tuning is needed; scans read large splits;
# skewed join partitions are split at run time; static broadcast choice
# uses file-size estimates under a modest threshold, and the library's own
# broadcasts are bounded by file bytes (``operators.joins.checked_broadcast``).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "paylens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (``extra``: more settings)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PAYLENS_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory).  Only when neither is set (tests, a laptop) a
    fresh temporary folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # the context appends a per-application uuid; scratch goes next to it
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(HDFS / object store); a machine-local folder does not survive "
                               "a lost executor")
        configured = tempfile.mkdtemp(prefix="paylens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for written tables."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_narrow(df, min_partitions: int | None = None):
    """Round-robin ``df`` over the cores when its scan yields fewer
    partitions than that (one big row group, one small file).

    Meant for CPU-heavy per-row work on whole texts (folds, HTML regexes).
    A large input already has many splits and is returned unchanged, so no
    shuffle is added at scale.  Catalyst pushes filters below a
    repartition, so this helps projections over every row, not selective
    predicates (those run in the scan tasks either way).
    """
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
