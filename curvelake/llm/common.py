"""What the operators share: tables, staging in the shared folder, numpy on Arrow columns."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession

from curvelake.session import shared_dir


#: Documents are long rows: small batches bound what a reader and an Arrow transfer hold at once.
_LONG_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": ("4096", "128"),
              "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "256")}


def long_rows(spark: SparkSession) -> SparkSession:
    """Batch sizes for long rows, where the session has Spark's defaults (other values stay)."""
    for key, (default, small) in _LONG_ROWS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, small)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, to be read in small batches."""
    return long_rows(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LEAST_FILES, PARTITIONS_PER_FILE = 32, 6


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder (not yet made) under ``spark.checkpoint.dir``, as a URI."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    It cuts the lineage: a lost executor costs the tasks that ran there, not the work
    before.  Files of one call are never overwritten.  Tables staged are small beside their
    input, so a file holds some shuffle partitions (PARTITIONS_PER_FILE) where there are many.
    """
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    files = max(LEAST_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_FILE)
    df.coalesce(files).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache(name: str) -> dict:
    """A dictionary that one Python worker keeps between the tasks that it runs."""
    holder = sys.modules.setdefault(f"_curvelake_{name}", types.ModuleType(name))
    return holder.__dict__.setdefault("kept", {})


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` as DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
