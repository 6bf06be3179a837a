"""Silver tables as bucketed catalog tables over the warehouse folders.

``silver treasury_yields`` is bucketed (hash) by ``series_id`` and sorted by
``(series_id, observation_date)``; ``sec_filings`` by its unique key
``accession_number``.  Reading a bucketed table gives Spark its partitioning
for free:

* per-series windows and the key-uniqueness check read it with no exchange;
* the insert-if-absent anti-join reads only the buckets that keys of the batch fall into; a batch
  that touches most of them is shuffled into the table's buckets, and the silver keys don't move.

Bucketing observations by series alone is safe from skew because a series
holds at most one row per calendar day; filings are bucketed by their unique
key, so a company with a large share of filings does not make a large bucket.

The catalog only holds the bucket spec for the session, so the spec is also
written next to the data (``<warehouse>/_layout``) and every later session
declares the tables with the stored numbers; declaring a different count over
existing files would misread them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curvelake.functions.exprs import literal_rows
from curvelake.session import BUCKETS, MAX_BUCKETS, setting
from curvelake.sinks.writers import time_id


@dataclass(frozen=True)
class Layout:
    observation_buckets: int
    filing_buckets: int


def _layout_path(root: str) -> str:
    return f"{root.rstrip('/')}/_layout"


def layout(spark: SparkSession, root: str, buckets: int | None = None) -> Layout:
    """The warehouse's stored bucket layout, written on first use (save mode
    ``ignore``: an existing layout is never replaced).  The number is ``buckets``, or the
    setting BUCKETS (``scale_conf`` sizes it from the data), or else the shuffle partitions
    up to MAX_BUCKETS."""
    n = buckets or int(spark.conf.get(BUCKETS, "0")) or min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "observation_buckets int, filing_buckets int"
    literal_rows(spark, [(n, n)], schema).coalesce(1).write.mode("ignore").json(_layout_path(root))
    row = spark.read.schema(schema).json(_layout_path(root)).first()
    return Layout(row.observation_buckets, row.filing_buckets)


def table_names(root: str) -> tuple[str, str]:
    """Catalog names of the two silver tables of a warehouse (one pair per path)."""
    h = hashlib.sha1(root.rstrip("/").encode()).hexdigest()[:12]
    return f"silver_treasury_yields_{h}", f"silver_sec_filings_{h}"


def _fs(spark: SparkSession, path: str):
    """A path of the Hadoop file system, and that file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    path, fs = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _split(path: str) -> tuple[str, str]:
    return tuple(path.rstrip("/").rsplit("/", 1))


def generations(spark: SparkSession, path: str) -> list[str]:
    """Folders that hold, or held, the table of the folder ``path``: that folder first, the current last."""
    parent, table = _split(path)
    marks = [n for n in _names(spark, f"{parent}/_generations") if n.startswith(f"{table}-g")]
    return [path.rstrip("/"), *[f"{parent}/{n}" for n in marks]]


def name_generation(spark: SparkSession, folder: str) -> None:
    """Make ``folder`` the current generation of its table."""
    parent, name = _split(folder)
    path, fs = _fs(spark, f"{parent}/_generations/{name}")
    fs.create(path, False).close()


def _declare(spark: SparkSession, name: str, columns: str, cluster: str, sort: str, buckets: int, location: str) -> None:
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet
                  CLUSTERED BY ({cluster}) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{location}'""")


_OBSERVATIONS = ("observation_date DATE, series_id STRING, value DECIMAL(10,4), ingested_at TIMESTAMP",
                 "series_id", "series_id, observation_date")
_FILINGS = ("accession_number STRING, cik STRING, company_name STRING, filing_type STRING, filing_date DATE, ingested_at TIMESTAMP",
            "accession_number", "accession_number")


def register_silver(spark: SparkSession, root: str, obs_path: str, fil_path: str,
                    buckets: int | None = None) -> tuple[str, str]:
    """``CREATE TABLE IF NOT EXISTS`` for both silver tables over their current generations; returns
    their names."""
    lay = layout(spark, root, buckets)
    names = table_names(root)
    for name, spec, n, path in zip(names, (_OBSERVATIONS, _FILINGS), (lay.observation_buckets, lay.filing_buckets),
                                   (obs_path, fil_path), strict=True):
        known = generations(spark, path)
        _declare(spark, name, *spec, n, known[-1])
        if len(known) > 1:  # compacted, perhaps since the table was declared
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{known[-1]}'")
        spark.catalog.refreshTable(name)  # another session may have written since this one listed the files
    return names


_FILE_BUCKET = re.compile(r"_(\d{5})(?:\.c\d+)?\.[^/]*$")


def bucket_of(column: str, buckets: int) -> Column:
    """The bucket that Spark puts a row in."""
    return F.pmod(F.hash(column), F.lit(buckets))


def touched_files(rows: DataFrame, buckets: set[int]) -> list[str]:
    """The files of a bucketed table that belong to ``buckets``, by the bucket number in their names."""
    return [f for f in rows.inputFiles() if (m := _FILE_BUCKET.search(f)) and int(m.group(1)) in buckets]


def rows_near(batch: DataFrame, table: str, column: str, buckets: int) -> DataFrame:
    """The rows of a bucketed table that can hold a key of ``batch``: those of the buckets its keys fall
    into (at most one number per bucket comes to the driver).  A batch that touches most buckets gets the
    table itself, whose buckets need no shuffle."""
    spark = batch.sparkSession
    rows = spark.table(table)
    touched = {r.b for r in batch.where(F.col(column).isNotNull()).select(bucket_of(column, buckets).alias("b")).distinct().collect()}
    if 2 * len(touched) > buckets:
        return rows
    files = touched_files(rows, touched)
    return spark.read.schema(rows.schema).parquet(*files) if files else literal_rows(spark, [], rows.schema)


def append_bucketed(rows: DataFrame, table: str, bucket_col: str, buckets: int,
                    sort_cols: list[str]) -> int:
    """Append to a bucketed table, one file per bucket and write; returns the
    row count measured during the write.

    ``repartition(buckets, col)`` uses the same hash as the table's bucket id,
    so each task holds exactly one bucket."""
    spark = rows.sparkSession
    cols = [f.name for f in spark.table(table).schema.fields]
    obs = Observation(f"append-{uuid.uuid4().hex[:12]}")
    out = rows.repartition(buckets, F.col(bucket_col)).sortWithinPartitions(*sort_cols).select(*cols)
    # with statistics in the files, unlike Spark's default, a filter on ingested_at skips older loads
    with setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        out.observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return int(obs.get.get("rows", 0) or 0)


def compact_bucketed(spark: SparkSession, table: str, path: str, bucket_col: str, buckets: int,
                     sort_cols: list[str]) -> None:
    """Write a bucketed table once more so that each bucket is one sorted file again (every append adds
    up to one file per bucket).  Run it when no load writes.

    The new generation is a table of its own until its rows are counted; naming it is one file.  The
    generation before stays for readers that still hold it; older ones, and what failed compactions
    left, are removed."""
    spark.catalog.refreshTable(table)
    known = generations(spark, path)
    parent, name = _split(path)
    folder = f"{parent}/{name}-g{time_id()}"
    build = f"{table}_{uuid.uuid4().hex[:12]}"
    source = spark.table(table)
    _declare(spark, build, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields),
             bucket_col, ", ".join(sort_cols), buckets, folder)
    try:
        # the scan reads bucket by bucket, so rows need no shuffle to their bucket
        with setting(spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):
            written = append_bucketed(source, build, bucket_col, buckets, sort_cols)
    finally:
        spark.sql(f"DROP TABLE {build}")  # the files stay: its location was given
    if written != source.count() or written != spark.read.schema(source.schema).parquet(folder).count():
        raise RuntimeError(f"{folder} does not hold the rows of {table}; it stays unused")
    name_generation(spark, folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    keep = {known[-1], folder}
    old = [g for g in known if g not in keep]
    left = [f"{parent}/{n}" for n in _names(spark, parent) if n.startswith(f"{name}-g")]
    for g in dict.fromkeys([*old, *left]):
        if g not in keep:
            _delete(spark, g)
            _delete(spark, f"{parent}/_generations/{_split(g)[1]}")


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)
