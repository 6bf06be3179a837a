"""Writers: bronze documents, key layout, versioned rewrites, validation results.

* Bronze: append-only; every call is one write with an id that sorts by time, and the reader
  takes the latest write of each (source, day, entity).  Writing an entity again replaces
  that entity's documents of that day and nothing else.
* Silver tables are bucketed catalog tables (``sinks.catalog``); for plain parquet outputs
  ``layout_by_key`` range-partitions and sorts by the key, so that files and row groups can
  be skipped for filters on the leading key columns.
* Config tables (upserts rewrite them): a new version directory per write, and one small file
  per version that names it; nothing is ever overwritten, the newest name wins.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake.functions.exprs import literal_rows
from curvelake.sources import bronze as B


def time_id() -> str:
    """An id that sorts by time."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def write_bronze(docs: DataFrame, root: str, source: str) -> str:
    """(entity_id, ingest_date, doc) -> bronze, any body as it is; returns the write's id.

    Every row is kept: a body that is no JSON object, or a row without entity id, is reported
    as a reject by the load."""
    w = time_id()
    (docs.select(F.col(B.ENTITY), F.col("doc"), F.lit(w).alias("write_id"), F.lit(source).alias("source"), "ingest_date")
     .write.mode("append").partitionBy("source", "ingest_date").parquet(root))
    return w


def layout_by_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Range-partition by the key and sort each file by it: a filter on the leading key
    columns opens few files, and in these few row groups.  The whole (unique) key sets the
    ranges, so a series or company with a large share of the rows spans several files.  The
    sampling pass reads ``df`` once more: give it staged rows where they are costly."""
    return df.repartitionByRange(*[F.col(c) for c in key]).sortWithinPartitions(*key)


# --- versioned config tables ------------------------------------------------


class MissingConfig(RuntimeError):
    """A config table that does not exist (a load without it would load nothing)."""


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest version, or None if there is no such table; other errors are raised."""
    try:
        return spark.read.schema("v string").parquet(_versions(root)).agg(F.max("v")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def read_versioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    v = current_version(spark, root)
    if v is None:
        raise MissingConfig(f"no config table at {root}; create it first (python -m curvelake config ...)")
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{v}")


def write_versioned(df: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None) -> str:
    """Write ``df`` as a new version, then name it; returns the version.  A reader sees the
    version before or the new one, never neither.  ``check`` gets the rows as written; if it raises,
    the version stays without a name."""
    spark = df.sparkSession
    v = "v" + time_id()
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{v}")
    if check is not None:
        check(spark.read.schema(df.schema).parquet(f"{root.rstrip('/')}/{v}"))
    literal_rows(spark, [(v,)], "v string").coalesce(1).write.mode("append").parquet(_versions(root))
    return v


def write_validation_results(results: DataFrame, path: str, suite: str, run_id: str) -> None:
    """Append the expectation results of one run."""
    (results.select(F.lit(suite).alias("suite"), F.lit(run_id).alias("run_id"),
                    F.current_timestamp().alias("validated_at"), "*")
     .coalesce(1).write.mode("append").parquet(path))
