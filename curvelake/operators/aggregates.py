"""Grouped and multi-level aggregates over observations.

All aggregates are hash aggregates with a map-side partial step, so a hot
group (one series with a large share of rows) is combined before the shuffle.
Global results (grand totals, the best month) are scalar subqueries or
aggregates over an already-aggregated result — never a window without
PARTITION BY over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import exprs as X
from curvelake.operators.ranking import global_rank
from curvelake.operators.series import DATE, SID, VAL, pick


def series_stats(obs: DataFrame) -> DataFrame:
    """Average and count per series."""
    return obs.groupBy(SID).agg(X.exact_avg(VAL).alias("avg_value"),
                                F.count(F.lit(1)).alias("observation_count"))


def count_per_series(obs: DataFrame) -> DataFrame:
    return obs.groupBy(SID).agg(F.count(F.lit(1)).alias("obs_count"))


def global_avg(obs: DataFrame) -> DataFrame:
    """Ungrouped average: one row."""
    return obs.agg(X.exact_avg(VAL).alias("avg_value"))


def pct_of_total(obs: DataFrame) -> DataFrame:
    """Per-series sum and its share of the grand total: the total of the sums, a scalar
    subquery over the same aggregate (whose exchange is reused)."""
    t = obs.groupBy(SID).agg(F.sum(VAL).alias("_t"))
    grand = t.agg(F.sum("_t").cast("double")).scalar()
    return t.select(SID, F.col("_t").cast("decimal(38,4)").alias("total_value"),
                    (F.lit(100.0) * F.col("_t").cast("double") / grand).alias("pct_of_total"))


def avg_by_month(obs: DataFrame) -> DataFrame:
    return (obs.groupBy(X.year().alias("year"), X.month().alias("month"))
            .agg(X.exact_avg(VAL).alias("avg_yield")))


def best_month(obs: DataFrame) -> DataFrame:
    """The (year, month) with the highest average over all series; ties kept.

    The monthly table has one row per calendar month, so the max is taken
    over that small aggregate (a scalar subquery), not over raw rows.
    """
    m = avg_by_month(obs)
    return m.where(F.col("avg_yield") == m.agg(F.max("avg_yield")).scalar())


def first_last(obs: DataFrame) -> DataFrame:
    """First/last date and the values on them, per series (no array collection)."""
    return obs.groupBy(SID).agg(
        F.max(DATE).alias("latest_date"), F.min(DATE).alias("first_date"),
        F.min_by(VAL, DATE).alias("first_value"), F.max_by(VAL, DATE).alias("last_value"))


def ordered_ends(obs: DataFrame, n: int) -> DataFrame:
    """Per series its first and its last ``n`` rows as arrays of (date, value), ``first_n`` from the
    first row on, ``last_n`` from the last one back.

    ``array_agg(... ORDER BY date)`` holds a series whole to look at a few places of it; here only rows
    that are among ``n`` at either end leave the window, so an array has at most ``n`` elements."""
    w = Window.partitionBy(SID).orderBy(DATE)
    from_end = F.count(F.lit(1)).over(Window.partitionBy(SID)) - F.row_number().over(w) + 1
    placed = obs.select(SID, DATE, VAL, F.row_number().over(w).alias("_first"), from_end.alias("_last"))
    kept = placed.where((F.col("_first") <= n) | (F.col("_last") <= n))

    def end(place: str):
        rows = F.array_sort(F.collect_list(F.when(F.col(place) <= n, F.struct(place, DATE, VAL))))
        return F.transform(rows, lambda r: F.struct(r[DATE].alias(DATE), r[VAL].alias(VAL)))

    return kept.groupBy(SID).agg(end("_first").alias("first_n"), end("_last").alias("last_n"))


def array_agg_ordered(obs: DataFrame) -> DataFrame:
    """``(array_agg(value ORDER BY date))[1]``, its second, last but one and last element: places of
    the bounded arrays of both ends (NULL where a series is shorter)."""
    first, last = F.col("first_n"), F.col("last_n")
    return ordered_ends(obs, 2).select(
        SID, F.get(last, 0)[DATE].alias("latest_date"), F.get(first, 0)[DATE].alias("first_date"),
        F.get(first, 0)[VAL].alias("first_value"), F.get(last, 0)[VAL].alias("last_value"),
        F.get(first, 1)[VAL].alias("second_value"), F.get(last, 1)[VAL].alias("last_but_one_value"))


def distinct_above(obs: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Series having at least one value above ``threshold``."""
    return obs.where(F.col(VAL) > X.dec(threshold)).select(SID).distinct()


def grouping_sets(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Average per (series, year, month), per (series, year), per series and over all rows
    (the empty set) in one pass (one Expand + one aggregate).  For a single series the last two
    are the same, and only the empty set is asked for."""
    d = pick(obs, series).select(SID, X.year().alias("year"), X.month().alias("month"), VAL)
    per_series = [] if series and len(series) == 1 else [[SID]]
    return (d.groupingSets([[SID, "year", "month"], [SID, "year"], *per_series, []], SID, "year", "month")
            .agg(X.exact_avg(VAL).alias("avg_yield")))


def rollup(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """ROLLUP(series_id, year, month) of the average, with GROUPING markers."""
    d = pick(obs, series).select(SID, X.year().alias("year"), X.month().alias("month"), VAL)
    return d.rollup(SID, "year", "month").agg(
        X.exact_avg(VAL).alias("avg_value"),
        F.grouping(SID).cast("bigint").alias("g_series"),
        F.grouping("year").cast("bigint").alias("g_year"),
        F.grouping("month").cast("bigint").alias("g_month"))


def cube(obs: DataFrame) -> DataFrame:
    """CUBE(series_id, year) of the observation count, with GROUPING markers."""
    d = obs.select(SID, X.year().alias("year"))
    return d.cube(SID, "year").agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.grouping(SID).cast("bigint").alias("g_series"),
        F.grouping("year").cast("bigint").alias("g_year"))


def rank_by_avg(obs: DataFrame) -> DataFrame:
    """Series ranked by average value, highest first: RANK and DENSE_RANK.

    The ranking runs over one row per series, with the distributed global
    rank (no single-task window even with millions of series).
    """
    a = obs.groupBy(SID).agg(X.exact_avg(VAL).alias("avg_yield"))
    return global_rank(a, "avg_yield", descending=True,
                       rank_col="rank_with_gaps", dense_col="rank_without_gaps")
