"""What a warehouse has seen: documents loaded by the stream, rejects, runs.

All three are append-only Parquet logs beside silver:

* ``silver/_ledger/<table>``: one row per loaded document (source, day, entity, write).  With the
  index of bronze it tells a micro-batch which documents are *due*: the latest write of each (source,
  day, entity), not loaded yet.  So the result does not depend on how files are dealt to
  micro-batches.  A crash between load and ledger only loads a document again, which inserts nothing.
* ``silver/_rejects/<table>``: rejects by content.  ``reject_key`` is a hash of the entity, the day, the
  document's hash, the position in it and the rule, so a second fault at a place where one was logged
  before is kept, and loading the same document again logs nothing.
* ``silver/_runs``: one row per run and source with its counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curvelake.functions.exprs import literal_rows
from curvelake.sources import bronze as B

#: a document's place; its write makes it a document (landed files have none)
PLACE = ["source", "ingest_date", B.ENTITY]
DOCUMENT = [*PLACE, "write_id"]
DOCUMENTS = f"source string, ingest_date date, {B.ENTITY} string, write_id string"
RUNS = ("run_id string, source string, finished_at timestamp, entities bigint, entities_seen bigint, "
        "inserted bigint, rejects bigint, new_rejects bigint")


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """A log, created empty if there is none."""
    literal_rows(spark, [], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


# --- documents ------------------------------------------------------------------


def semi(a: DataFrame, b: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``a`` that ``b`` has (``left_anti``: has not) by columns that may be NULL."""
    other = b.select(*[F.col(c).alias(f"_other_{c}") for c in columns]).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_other_{c}"))
    return a.join(other, same, how)


def due_documents(batch: DataFrame, bronze: DataFrame, loaded: DataFrame) -> DataFrame:
    """The documents (DOCUMENT columns) to load when those of ``batch`` arrive.

    For the entities of ``batch`` and the days up to its last one: of the documents that bronze holds (or
    the batch; its files may be archived by now) the latest write of each place and every landed file, if
    not ``loaded`` before.  A write older than one that was loaded is not due either.  Documents without
    entity or day have no order; they are due as they come.  Only keys are read here, no bodies."""
    batch = batch.select(*DOCUMENT)
    placed = batch.where(F.col(B.ENTITY).isNotNull() & F.col("ingest_date").isNotNull())
    entities = placed.groupBy("source", B.ENTITY).agg(F.max("ingest_date").alias("_last"))
    near = bronze.select(*DOCUMENT).join(entities, ["source", B.ENTITY]).where("ingest_date <= _last").drop("_last")
    known = near.select(*DOCUMENT).unionByName(placed).distinct()
    before = loaded.select(*DOCUMENT).join(entities.drop("_last"), ["source", B.ENTITY], "left_semi").select(*DOCUMENT)
    newest = known.unionByName(before).groupBy(*PLACE).agg(F.max("write_id").alias("_newest"))
    latest = known.join(newest, PLACE).where(F.col("write_id").isNull() | (F.col("write_id") == F.col("_newest"))).select(*DOCUMENT)
    unplaced = batch.where(F.col(B.ENTITY).isNull() | F.col("ingest_date").isNull()).distinct()
    return semi(latest, before, DOCUMENT, "left_anti").unionByName(unplaced)


# --- rejects and runs -----------------------------------------------------------


def reject_key(entity: str) -> Column:
    """What makes a reject the same one: where it is, in which content, by which rule."""
    return F.sha2(F.to_json(F.struct(F.col(entity).alias("entity"), "ingest_date", "doc_id", "pos", "reject_reason")), 256)


def append_rejects(rejects: DataFrame, path: str, entity: str, run_id: str) -> int:
    """Append the rejects that are not logged yet; returns how many."""
    spark = rejects.sparkSession
    rows = rejects.withColumn("reject_key", reject_key(entity)).withColumn("run_id", F.lit(run_id))
    logged = read_log(spark, path, rows.schema).select("reject_key")
    new = rows.dropDuplicates(["reject_key"]).join(logged, "reject_key", "left_anti").select(*rows.columns)
    seen = Observation(f"rejects-{uuid.uuid4().hex[:12]}")
    new.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(seen.get.get("rows", 0) or 0)


def append_run(spark: SparkSession, path: str, run_id: str, source: str, entities: int, seen: int,
               inserted: int, rejects: int, new_rejects: int) -> None:
    row = literal_rows(spark, [(run_id, source, entities, seen, inserted, rejects, new_rejects)],
                       "run_id string, source string, entities bigint, entities_seen bigint, inserted bigint, rejects bigint, new_rejects bigint")
    row.select("run_id", "source", F.current_timestamp().alias("finished_at"), "entities", "entities_seen", "inserted",
               "rejects", "new_rejects").coalesce(1).write.mode("append").parquet(path)
