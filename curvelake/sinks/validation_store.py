"""Validation kept up from what silver gained.

A silver key lives in one bucket, so the counts behind a suite's results (``quality.counts_by``) add up
over buckets, the duplicate keys too.  They are stored per bucket.  After a load only the buckets that
gained rows (``ingested_at``) are read again, whole, since a new row may repeat an old key; their counts
replace those stored, and the results over all buckets are those of the full suite.  A part is written and
then named by one file, which says up to which moment and for which files' layout it holds; a run that
fails leaves a folder without a name.

Counts of the rows that were checked stay as they were: rows of silver are only ever added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake.functions.exprs import literal_rows
from curvelake.operators import constraints as C
from curvelake.operators import quality as Q
from curvelake.sinks import catalog as CT
from curvelake.sinks.writers import time_id

BUCKET = "_bucket"
#: table -> (its silver rows, its folder, its bucket column, its suite)
_TABLES = {"observations": (jobs.silver_observations, "observations", "series_id", Q.observation_suite),
           "filings": (jobs.silver_filings, "filings", "accession_number", lambda: C.suite("filings"))}


def _root(wh: jobs.Warehouse, table: str) -> str:
    return wh.path("quality", "_buckets", table)


def parts(spark: SparkSession, wh: jobs.Warehouse, table: str) -> list[tuple[str, int]]:
    """(folder, up to which microsecond) in the order of their writing."""
    named = [n.split("~") for n in CT._names(spark, f"{_root(wh, table)}/_parts")]
    return [(f"{_root(wh, table)}/p-{part}", int(upto)) for part, upto in named]


def refresh(spark: SparkSession, wh: jobs.Warehouse, table: str = "observations") -> int:
    """Count the buckets that gained rows since the last call again; returns how many."""
    rows_of, _, column, suite = _TABLES[table]
    rows, have = rows_of(spark, wh), parts(spark, wh, table)
    layout = CT.layout(spark, wh.root)
    n = layout.observation_buckets if table == "observations" else layout.filing_buckets
    new = rows.where(F.col("ingested_at") > F.timestamp_micros(F.lit(have[-1][1]))) if have else rows
    found = new.groupBy(CT.bucket_of(column, n).alias("b")).agg(F.max(F.unix_micros("ingested_at")).alias("upto")).collect()  # one row per bucket
    if not found:
        return 0
    files = CT.touched_files(rows, {r.b for r in found})
    read = spark.read.schema(rows.schema).parquet(*files).drop("ingested_at").withColumn(BUCKET, CT.bucket_of(column, n))
    part = time_id()
    Q.counts_by(read, suite(), BUCKET).write.parquet(f"{_root(wh, table)}/p-{part}")
    name, fs = CT._fs(spark, f"{_root(wh, table)}/_parts/{part}~{max(r.upto for r in found)}")
    fs.create(name, False).close()
    return len(found)


def results(spark: SparkSession, wh: jobs.Warehouse, table: str = "observations") -> DataFrame:
    """The suite's results over all of silver, as of the last refresh."""
    rows_of, _, _, suite = _TABLES[table]
    columns = [c for c in rows_of(spark, wh).columns if c != "ingested_at"]
    empty = Q.counts_by(rows_of(spark, wh).drop("ingested_at").withColumn(BUCKET, F.lit(0)), suite(), BUCKET)
    have = parts(spark, wh, table)
    if not have:
        return Q.add_up(literal_rows(spark, [], empty.schema), suite(), columns)
    stored = None
    for nth, (folder, _) in enumerate(have):
        part = spark.read.schema(empty.schema).parquet(folder).withColumn("_part", F.lit(nth))
        stored = part if stored is None else stored.unionByName(part)
    last = F.row_number().over(Window.partitionBy(BUCKET).orderBy(F.desc("_part")))
    return Q.add_up(stored.withColumn("_nth", last).where("_nth = 1").drop("_nth", "_part"), suite(), columns)


def validate_new(spark: SparkSession, wh: jobs.Warehouse, table: str = "observations") -> DataFrame:
    """Refresh, then gate on the results over all of silver."""
    refresh(spark, wh, table)
    held = results(spark, wh, table)
    return Q.gate(literal_rows(spark, [tuple(r) for r in held.collect()], held.schema))
