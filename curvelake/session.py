"""Spark session defaults and the shared work folder.

The defaults are the ones a cluster job wants as well: adaptive query
execution (runtime partition coalescing, skew-join splitting, runtime
broadcast decisions from *measured* shuffle sizes), UTC as the session time
zone, and no web UI.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Broadcast only below this measured/estimated size; larger sides fall back
# to a shuffled sort-merge join.  Spark checks it against plan statistics at
# planning time and again (AQE) against the real shuffle size at run time.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized from the input volume and the cluster shape.

    * scan splits of ``target_partition_bytes`` (``maxPartitionBytes``);
    * shuffle partitions: enough that a full-width shuffle of the input gives
      partitions near the target size, and at least 3 waves of the cluster's
      cores; AQE then coalesces small ones at run time (so the number only has
      to be large enough, never exact);
    * skew: a shuffle partition is split when it is 5x the median and above
      4x the target size.

    e.g. 100 TB on 1000 executors x 8 cores -> ~800k scan tasks of 128 MB and
    819,200 initial shuffle partitions, coalesced by AQE after partial
    aggregation has shrunk the data.
    """
    cores = executors * cores_per_executor
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.default.parallelism": str(2 * cores),
        BUCKETS: str(bucket_count(input_bytes, cores)),
    }


#: Buckets of a silver table, fixed when the warehouse is created.
BUCKETS = "spark.curvelake.buckets"
BUCKET_BYTES = 2 * 1024 ** 3
MAX_BUCKETS = 50_000  # Spark's own bound is spark.sql.sources.bucketing.maxBuckets, 100,000


def bucket_count(table_bytes: int, cores: int = 1) -> int:
    """Buckets of about BUCKET_BYTES, at least one per core, at most MAX_BUCKETS."""
    return min(MAX_BUCKETS, max(cores, -(-table_bytes // BUCKET_BYTES)))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "curvelake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` should be sized so that one shuffle partition is
    100-200 MB at the target scale; AQE coalesces small ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, to storage that every executor reaches.  Only a local
    master without the setting (tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(sc.applicationId)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="curvelake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs run inside, then the caller's own again."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def staged(df: DataFrame, name: str):
    """``df`` as Parquet in the shared folder for the jobs run inside; removed afterwards
    (also after an error), so a finished load leaves nothing behind."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
