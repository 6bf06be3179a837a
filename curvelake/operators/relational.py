"""Projections, filters, joins, top-k, unions, calendars and subqueries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.functions import exprs as X
from curvelake.operators.series import DATE, SID, VAL, pick

# --- projections and filters ------------------------------------------------


def project_staging(silver: DataFrame) -> DataFrame:
    """The staging model: the three business columns of the silver table."""
    return silver.select(DATE, SID, VAL)


def filter_series_eq(obs: DataFrame, series_id: str = "DGS10") -> DataFrame:
    return obs.where(F.col(SID) == series_id).select(DATE, SID, VAL)


def filter_like_prefix(obs: DataFrame, prefix: str = S.TREASURY_PREFIX) -> DataFrame:
    """``series_id LIKE 'prefix%'`` (a StartsWith that reaches the scan)."""
    return obs.where(F.col(SID).startswith(prefix))


def filter_gt_const(obs: DataFrame, threshold: float = 5.0) -> DataFrame:
    return obs.where(F.col(VAL) > X.dec(threshold))


def filter_in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_flag(df: DataFrame, flag: str = "is_active") -> DataFrame:
    return df.where(F.col(flag))


# --- joins ------------------------------------------------------------------


def join_filings_companies(fil: DataFrame, comp: DataFrame) -> DataFrame:
    """Filings ⋈ companies on the zero-stripped cik (computed join key).

    No broadcast hint: Spark broadcasts the company side only when its
    measured size is under the broadcast limit, otherwise it shuffles both
    sides; AQE splits a company with an outsized share of filings.
    """
    c = comp.select(F.col("cik").alias("_c_cik"), "ticker", F.col("name").alias("company"))
    j = fil.join(c, X.strip_leading_zeros(fil["cik"]) == c["_c_cik"], "inner")
    return j.select("accession_number", "cik", "ticker", "company", "filing_type", "filing_date")


def join_scalar_avg(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Each observation next to its series' overall average.

    The source computes the average once and joins it back; here it is a
    whole-partition window per series — one scan and one exchange instead of
    two scans and a join (a series partition is bounded by its dates)."""
    w = Window.partitionBy(SID)
    avg = F.sum(VAL).over(w).cast("double") / F.count(VAL).over(w)
    return pick(obs, series).select(DATE, SID, VAL, avg.alias("overall_avg"))


def join_grand_total(obs: DataFrame) -> DataFrame:
    """Per-series totals next to the grand total: a join with a one-row aggregate of the
    totals on a constant key (``pct_of_total`` has the scalar-subquery form)."""
    t = obs.groupBy(SID).agg(F.sum(VAL).alias("_t")).withColumn("_k", F.lit(1))
    grand = t.groupBy("_k").agg(F.sum("_t").alias("_g"))
    return t.join(grand, "_k").select(SID, F.col("_t").cast("decimal(38,4)").alias("total_value"),
                                      F.col("_g").cast("decimal(38,4)").alias("grand_total"))


def join_rownum_series(obs: DataFrame) -> DataFrame:
    """Numbered rows joined with the numbers 1..N of their series, which come from its row
    count alone: a number without a row would show as NULL."""
    w = Window.partitionBy(SID).orderBy(DATE)
    rows = obs.select(SID, DATE, VAL, F.row_number().over(w).cast("bigint").alias("row_num"))
    numbers = (obs.groupBy(SID).agg(F.count(F.lit(1)).alias("_n"))
               .select(SID, F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")).alias("row_num")))
    return numbers.join(rows, [SID, "row_num"], "left").select(SID, "row_num", DATE, VAL)


def join_date_max(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Dates on which a series had the highest value of all series (ties kept).

    Daily maxima are aggregated (partial + final) and joined back on
    (date, value); a window ``max() OVER (PARTITION BY date)`` would put every
    series of a date into one partition.
    """
    m = obs.groupBy(F.col(DATE).alias("_d")).agg(F.max(VAL).alias("_max"))
    d = pick(obs, series)
    j = d.join(m, (F.col(DATE) == F.col("_d")) & (F.col(VAL) == F.col("_max")), "inner")
    return j.select(DATE, SID, VAL)


def above_global_avg(obs: DataFrame) -> DataFrame:
    """Observations above the table-wide average (an uncorrelated scalar subquery)."""
    avg = obs.agg(X.exact_avg(VAL)).scalar()
    return obs.where(F.col(VAL) > avg).select(VAL, SID, DATE)


# --- ordering and limits ----------------------------------------------------


def topk_latest(obs: DataFrame, series_id: str = "DGS10", k: int = 10) -> DataFrame:
    """Latest ``k`` observations of one series (TakeOrderedAndProject)."""
    return (obs.where(F.col(SID) == series_id)
            .orderBy(F.col(DATE).desc(), F.col(SID).asc()).limit(k))


def limit_view(curve: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` rows of a date-keyed gold view, newest first (sorted here:
    a sort inside a view does not survive later operators)."""
    return curve.orderBy(F.col(DATE).desc()).limit(k)


# --- unions, calendars ------------------------------------------------------


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``SELECT 'name', COUNT(*) FROM t UNION ALL …``"""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def date_series(spark, start: dt.date, end: dt.date) -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive (no recursion)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("dt"))


def series_calendar(obs: DataFrame) -> DataFrame:
    """One row per calendar day from each series' first to last observation,
    with the observed value or NULL (a gap-filled spine).

    The spine is generated per series from its (min, max) dates — one small
    row per series before the explode — and outer-joined back on both keys.
    """
    span = obs.groupBy(SID).agg(F.min(DATE).alias("_lo"), F.max(DATE).alias("_hi"))
    days = span.select(SID, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("dt"))
    j = days.join(obs.withColumnRenamed(DATE, "dt"), [SID, "dt"], "left")
    return j.select(SID, "dt", VAL)
