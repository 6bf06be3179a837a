"""Batch jobs: the daily load and the backfill.

A warehouse root holds::

    <wh>/reference/series/      versioned config (series_id, name, category, is_active, created_at)
    <wh>/reference/companies/   versioned config (cik, ticker, name, is_active, created_at)
    <wh>/silver/treasury_yields/   append-only, bucketed by series_id (catalog table)
    <wh>/silver/sec_filings/       append-only, bucketed by accession_number
    <wh>/_layout                   the bucket counts, fixed at creation
    <wh>/silver/_rejects/{observations,filings}/   rejects by content, each once (``sinks.ledger``)
    <wh>/silver/_ledger/observations/   documents that the stream has loaded
    <wh>/silver/_runs/          one row per run and source
    <wh>/quality/results/

The source system fetched one entity at a time on a thread pool and inserted
row by row; here each source is ONE distributed job over that day's bronze
documents: parse and type (staged once as Parquet in the shared folder and removed after the
load), de-duplicate, anti-join with silver, append.

A load without config fails: an absent table would silently load nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows, strip_leading_zeros
from curvelake.operators import constraints as C
from curvelake.operators import merge as M
from curvelake.operators import quality as Q
from curvelake.operators import silver as SV
from curvelake.session import setting, staged
from curvelake.sinks import ledger as LG
from curvelake.sinks import writers as W
from curvelake.sinks.catalog import append_bucketed, compact_bucketed, layout, register_silver, rows_near
from curvelake.sources import bronze as B


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def observations(self) -> str:
        return self.path("silver", "treasury_yields")

    @property
    def filings(self) -> str:
        return self.path("silver", "sec_filings")

    @property
    def series(self) -> str:
        return self.path("reference", "series")

    @property
    def companies(self) -> str:
        return self.path("reference", "companies")


SILVER_OBS = T.StructType(S.OBSERVATIONS.fields + [T.StructField("ingested_at", T.TimestampType())])
SILVER_FIL = T.StructType(S.FILINGS.fields + [T.StructField("ingested_at", T.TimestampType())])
SERIES_CONFIG = T.StructType([*S.SERIES.fields, S.CREATED_AT])
COMPANIES_CONFIG = T.StructType([*S.COMPANIES.fields, S.CREATED_AT])

#: unexpected values that a stored validation result keeps of each rule
EXAMPLES = 20

#: With a join on (date, series) this lets silver's bucketing by series alone serve as its
#: partitioning; a series is bounded by its dates.  Held only while a load runs.
_CO_PARTITION = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def _run_id() -> str:
    return W.time_id()


def series_config(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return W.read_versioned(spark, wh.series, SERIES_CONFIG)


def companies_config(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return W.read_versioned(spark, wh.companies, COMPANIES_CONFIG)


def write_config(df: DataFrame, root: str) -> str:
    """Store a config table as its next version; rows without ``created_at`` get this moment.
    A version that breaks a declared constraint is never named, so no reader sees it."""
    now = F.current_timestamp()
    made = F.coalesce("created_at", now) if "created_at" in df.columns else now
    table = root.rstrip("/").rsplit("/", 1)[-1]
    return W.write_versioned(df.withColumn("created_at", made), root, check=lambda written: C.enforce(written, table))


def create_tables(spark: SparkSession, wh: Warehouse, buckets: int | None = None) -> tuple[str, str]:
    """``CREATE TABLE IF NOT EXISTS`` for the silver tables: bucketed catalog tables over the
    warehouse folders (see ``sinks.catalog``), with their present files; returns their names."""
    return register_silver(spark, wh.root, wh.observations, wh.filings, buckets)


def silver_observations(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return spark.table(create_tables(spark, wh)[0])


def silver_filings(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return spark.table(create_tables(spark, wh)[1])


@dataclass(frozen=True)
class Counts:
    """Of one source: active config rows, entities with a document, rows inserted, rejects and
    those of them that were not logged before."""

    active: int
    seen: int
    inserted: int
    rejects: int = 0
    new_rejects: int = 0


def _finish(spark: SparkSession, wh: Warehouse, source: str, run_id: str, counts: Counts) -> Counts:
    """Log the run."""
    LG.append_run(spark, wh.path("silver", "_runs"), run_id, source, counts.active, counts.seen, counts.inserted,
                  counts.rejects, counts.new_rejects)
    return counts


def runs(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The warehouse's loads so far."""
    return LG.read_log(spark, wh.path("silver", "_runs"), LG.RUNS)


def load_observation_docs(spark: SparkSession, docs: DataFrame, wh: Warehouse,
                          gate_before_append: bool = False, run_id: str | None = None) -> Counts:
    """Parsed observation docs -> silver.

    ``gate_before_append`` runs the observation suite over the batch's typed
    rows (already staged, so cheap) and raises before anything is
    appended; by default, as in the source flow, validation runs after the
    load over the whole table (``validate``)."""
    active = series_config(spark, wh).where("is_active").select("series_id")
    # a document without a series id can't be looked up; it goes on and is rejected
    docs = docs.join(active, "series_id", "left_semi").unionByName(docs.where("series_id IS NULL"))
    table = create_tables(spark, wh)[0]
    buckets = layout(spark, wh.root).observation_buckets
    typed = SV.typing_observations(B.observation_rows(docs, keep_empty=True))
    with setting(spark, *_CO_PARTITION), staged(typed, "load-observations") as t:
        load = SV.load_typed_observations(t, rows_near(t, table, "series_id", buckets), buckets)
        if gate_before_append:
            good = t.where(F.col("reject_reason").isNull())
            Q.gate(Q.run_suite(good.select("observation_date", "series_id", "value"), Q.observation_suite()))
        new = load.new_rows.withColumn("ingested_at", F.current_timestamp())
        inserted = append_bucketed(new, table, "series_id", buckets, ["series_id", "observation_date"])
        run_id = run_id or _run_id()
        logged = LG.append_rejects(load.rejects, wh.path("silver", "_rejects", "observations"), "series_id", run_id)
        seen = t.select("series_id").where("series_id IS NOT NULL").distinct().count()
        return _finish(spark, wh, "fred", run_id, Counts(active.count(), seen, inserted, load.rejects.count(), logged))


def load_filing_docs(spark: SparkSession, docs: DataFrame, wh: Warehouse, run_id: str | None = None) -> Counts:
    active = companies_config(spark, wh).where("is_active").select(F.col("cik").alias("_cik"))
    own = strip_leading_zeros(F.coalesce("cik", B.ENTITY))
    known = docs.join(active, own == F.col("_cik"), "left_semi")
    docs = known.unionByName(docs.where(F.col("cik").isNull() & F.col(B.ENTITY).isNull()))
    table = create_tables(spark, wh)[1]
    buckets = layout(spark, wh.root).filing_buckets
    typed = SV.typing_filings(B.filing_rows(docs, keep_empty=True))
    with setting(spark, *_CO_PARTITION), staged(typed, "load-filings") as t:
        load = SV.load_typed_filings(t, rows_near(t, table, "accession_number", buckets), buckets)
        new = load.new_rows.withColumn("ingested_at", F.current_timestamp())
        inserted = append_bucketed(new, table, "accession_number", buckets, ["accession_number"])
        run_id = run_id or _run_id()
        logged = LG.append_rejects(load.rejects, wh.path("silver", "_rejects", "filings"), "cik", run_id)
        seen = t.select("cik").where("cik <> ''").distinct().count()
        return _finish(spark, wh, "sec", run_id, Counts(active.count(), seen, inserted, load.rejects.count(), logged))


def run_daily(spark: SparkSession, bronze_root: str, wh: Warehouse, ingest_date: dt.date,
              gate_before_append: bool = False) -> DataFrame:
    """Load one ingest day of both sources; one result row per source: active config rows,
    entities seen in documents (fewer: a fetch is missing), rows inserted."""
    return backfill(spark, bronze_root, wh, ingest_date, ingest_date, gate_before_append)


def backfill(spark: SparkSession, bronze_root: str, wh: Warehouse, start: dt.date, end: dt.date,
             gate_before_append: bool = False) -> DataFrame:
    """Load every ingest day in [start, end] in one job per source.

    Same result as loading day by day: inserts are first-wins, and documents
    are ordered by ingest date inside the job.
    """
    create_tables(spark, wh)
    rng = (start, end)
    obs_docs = B.read_observation_docs(spark, bronze_root, rng)
    fil_docs = B.read_filing_docs(spark, bronze_root, rng)
    run_id = _run_id()
    obs = load_observation_docs(spark, obs_docs, wh, gate_before_append, run_id)
    fil = load_filing_docs(spark, fil_docs, wh, run_id)
    label = str(start) if start == end else f"{start}..{end}"
    return literal_rows(spark, [(label, "fred", obs.active, obs.seen, obs.inserted), (label, "sec", fil.active, fil.seen, fil.inserted)],
                        "date string, source string, entities bigint, entities_seen bigint, silver_rows bigint")


def validate(spark: SparkSession, wh: Warehouse, run_id: str, table: str = "observations") -> DataFrame:
    """Run the suite of ``observations`` or ``filings`` over the whole silver table, store the
    results, then gate (raises on failure: downstream stops).  The suite runs once: its few
    result rows are held and reused."""
    if table == "observations":
        rows, suite, name = silver_observations(spark, wh), Q.observation_suite(), "fred_data_suite"
    else:
        rows, suite, name = silver_filings(spark, wh), C.suite(table), "sec_data_suite"
    res = Q.run_suite(rows.drop("ingested_at"), suite, samples=EXAMPLES)
    held = literal_rows(spark, [tuple(r) for r in res.collect()], res.schema)
    W.write_validation_results(held, wh.path("quality", "results"), name, run_id)
    return Q.gate(held)


def compact(spark: SparkSession, wh: Warehouse) -> None:
    """One sorted file per bucket again in both silver tables; run it when no load writes."""
    obs, fil = create_tables(spark, wh)
    lay = layout(spark, wh.root)
    compact_bucketed(spark, obs, wh.observations, "series_id", lay.observation_buckets, ["series_id", "observation_date"])
    compact_bucketed(spark, fil, wh.filings, "accession_number", lay.filing_buckets, ["accession_number"])
    create_tables(spark, wh)


def change_config(spark: SparkSession, wh: Warehouse, action: str, table: str = "series", directory: str | None = None,
                  ids: list[str] | None = None, row: list[str] | None = None) -> DataFrame:
    """Change a config table (``seed``, ``companies``, ``activate``, ``deactivate``, ``add``) or
    ``list`` it; returns the table as it is then.

    ``seed`` and ``companies`` insert or update and create the table if there is none; flags
    and creation times of known rows stay.  ``ids`` are series ids or tickers."""
    table = {"seed": "series", "companies": "companies"}.get(action, table)
    root, schema, column = ((wh.series, SERIES_CONFIG, "series_id") if table == "series"
                            else (wh.companies, COMPANIES_CONFIG, "ticker"))
    absent = W.current_version(spark, root) is None and action in ("seed", "companies", "add")
    now = literal_rows(spark, [], schema) if absent else W.read_versioned(spark, root, schema)
    if action == "seed":
        seed = literal_rows(spark, [(s, n, c) for s, n, c in S.SERIES_SEED], "series_id string, name string, category string")
        new = SV.upsert_series(now, seed)
    elif action == "companies":
        new = SV.upsert_companies(now, B.ticker_rows(B.read_company_directory(spark, directory)))
    elif action in ("activate", "deactivate"):
        flag = action == "activate"
        new = M.set_flag(now, "is_active", flag) if ids is None else M.set_flag_where_in(now, "is_active", flag, column, ids)
    elif action == "add":
        names = [f.name for f in schema.fields][:3]
        new = SV.insert_config_rows(now, literal_rows(spark, [tuple(row)], ", ".join(f"{n} string" for n in names)), table)
    else:
        return now
    write_config(new, root)
    return W.read_versioned(spark, root, schema)
