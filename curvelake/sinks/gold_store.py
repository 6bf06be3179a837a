"""Gold kept fresh from what silver gained.

The store holds partial aggregates that merge: per date the pivoted cells of all gold columns (a
(date, series) pair has one value ever, so the larger of two cells is the one that is there), per company
counts and first and last day.  ``refresh`` aggregates the rows that silver gained since the last refresh
(``ingested_at``) and adds them as one more part, so its work grows with these rows, not with silver:
the filter reaches the Parquet scan, where whole row groups of older loads are skipped.  A part is written
first and then named by one file, which also says up to which moment it goes; a refresh that fails leaves
a folder without a name, and the next one does its rows again.

Readers merge the parts (one row per date or company and part).  After FOLD_PARTS parts a refresh folds
them into one, which then counts instead of all before it.

    <wh>/gold/_store/<table>/p-<id>/                a part
    <wh>/gold/_store/<table>/_parts/<id>~<micros>~<add|all>
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows
from curvelake.operators import gold
from curvelake.sinks import catalog as CT
from curvelake.sinks.writers import time_id

FOLD_PARTS = 16
#: every pivoted column of the gold datasets
CELLS = {**S.FULL_CURVE_TENORS, **S.YIELD_CURVE_TENORS, **S.STRESS_LEGS}
DATASETS = ("yield_curve", "full_yield_curve", "credit_stress", "daily_snapshot", "company_filings_summary")
_COUNTS = ("total_filings", "annual_reports", "quarterly_reports", "current_reports")


def _curve_part(obs: DataFrame) -> DataFrame:
    return obs.groupBy("observation_date").agg(
        *gold.pivot_columns(CELLS), F.bool_or(F.col("series_id").startswith(S.TREASURY_PREFIX)).alias("_treasury"))


def _merge_curve(parts: DataFrame) -> DataFrame:
    return parts.groupBy("observation_date").agg(*[F.max(c).alias(c) for c in CELLS], F.bool_or("_treasury").alias("_treasury"))


def _merge_filings(parts: DataFrame) -> DataFrame:
    return parts.groupBy("cik").agg(*[F.sum(c).cast("bigint").alias(c) for c in _COUNTS],
                                    F.min("earliest_filing").alias("earliest_filing"), F.max("latest_filing").alias("latest_filing"))


#: table -> (its silver rows, a part of rows, the merge of parts)
_TABLES = {"curve": (jobs.silver_observations, _curve_part, _merge_curve),
           "filings": (jobs.silver_filings, gold.filings_per_cik, _merge_filings)}


def _root(wh: jobs.Warehouse, table: str) -> str:
    return wh.path("gold", "_store", table)


def parts(spark: SparkSession, wh: jobs.Warehouse, table: str) -> list[tuple[str, int]]:
    """(folder, up to which microsecond) of the parts that count, in order."""
    named = [n.split("~") for n in CT._names(spark, f"{_root(wh, table)}/_parts")]
    start = max((i for i, (_, _, kind) in enumerate(named) if kind == "all"), default=0)
    return [(f"{_root(wh, table)}/p-{part}", int(upto)) for part, upto, _ in named[start:]]


def _add(spark: SparkSession, wh: jobs.Warehouse, table: str, rows: DataFrame, upto: int, kind: str) -> None:
    part = time_id()
    rows.write.parquet(f"{_root(wh, table)}/p-{part}")
    name, fs = CT._fs(spark, f"{_root(wh, table)}/_parts/{part}~{upto}~{kind}")
    fs.create(name, False).close()


def _stored(spark: SparkSession, wh: jobs.Warehouse, table: str) -> DataFrame:
    """The merged parts."""
    rows, part, merge = _TABLES[table]
    schema = part(rows(spark, wh)).schema
    folders = [folder for folder, _ in parts(spark, wh, table)]
    read = spark.read.schema(schema).parquet(*folders) if folders else literal_rows(spark, [], schema)
    return merge(read)


def gained(spark: SparkSession, wh: jobs.Warehouse, table: str) -> tuple[DataFrame, int | None]:
    """Silver rows since the last part, and the moment they go up to (None: no rows)."""
    have = parts(spark, wh, table)
    rows = _TABLES[table][0](spark, wh)
    at = F.unix_micros("ingested_at")
    if have:
        rows = rows.where(F.col("ingested_at") > F.timestamp_micros(F.lit(have[-1][1])))
    upto = rows.agg(F.max(at)).first()[0]
    return rows if upto is None else rows.where(F.col("ingested_at") <= F.timestamp_micros(F.lit(upto))), upto


def refresh(spark: SparkSession, wh: jobs.Warehouse) -> None:
    """Bring the store up to silver; run it when no load writes."""
    for table, (_, part, _) in _TABLES.items():
        rows, upto = gained(spark, wh, table)
        if upto is not None:
            _add(spark, wh, table, part(rows), upto, "add")
        have = parts(spark, wh, table)
        if len(have) > FOLD_PARTS:
            _add(spark, wh, table, _stored(spark, wh, table), have[-1][1], "all")


def dataset(spark: SparkSession, wh: jobs.Warehouse, name: str) -> DataFrame:
    """A gold dataset (one of DATASETS) from the store, as the function of ``operators.gold`` gives it
    over all of silver."""
    if name == "company_filings_summary":
        return gold.finish_filings(_stored(spark, wh, "filings"), jobs.companies_config(spark, wh))
    curve = _stored(spark, wh, "curve")
    finish = {"yield_curve": gold.finish_yield_curve, "full_yield_curve": gold.finish_full_curve,
              "credit_stress": gold.finish_stress, "daily_snapshot": gold.finish_snapshot}[name]
    return finish(curve.where("_treasury") if name in ("full_yield_curve", "daily_snapshot") else curve)
