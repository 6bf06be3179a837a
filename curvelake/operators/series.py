"""Per-series window operators: lags, changes, moving statistics, ranks,
quantiles, top-n, gaps and repeats.

Every window is ``PARTITION BY series_id``; the source queries pin one series
(``WHERE series_id = 'DGS10'``) and window over the whole table, which in
Spark would be a single-partition exchange.  Here each operator takes an
optional ``series`` list: ``series=['DGS10']`` reproduces the single-series
query, ``None`` runs every series at once.

Scale: observations are unique on ``(observation_date, series_id)`` (the
silver writer enforces it), so one window partition holds at most one row per
calendar day of the series — partitions are bounded by the date span, never by
table size, and parallelism comes from the number of series.  Windows with the
same partitioning and ordering share one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import exprs as X

DATE, SID, VAL = "observation_date", "series_id", "value"


def pick(obs: DataFrame, series: list[str] | None) -> DataFrame:
    """Restrict to some series (pushed below the scan/aggregate by Catalyst)."""
    return obs if series is None else obs.where(F.col(SID).isin(list(series)))


def by_date() -> Window:
    return Window.partitionBy(SID).orderBy(F.col(DATE).asc())


def rows_back(n: int) -> Window:
    """``ROWS BETWEEN n PRECEDING AND CURRENT ROW`` by date."""
    return by_date().rowsBetween(-n, Window.currentRow)


def by_value_desc() -> Window:
    # DESC puts NULLs first (the source engine's default); date breaks ties.
    return Window.partitionBy(SID).orderBy(F.col(VAL).desc_nulls_first(), F.col(DATE).asc())


def moving_avg(n_rows: int) -> Column:
    """Average over the last ``n_rows`` rows, exact-sum form."""
    w = rows_back(n_rows - 1)
    return F.sum(VAL).over(w).cast("double") / F.count(VAL).over(w)


# --- lags and changes -------------------------------------------------------

def lag_change(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Previous value, day-over-day change and a direction label."""
    prev = F.lag(VAL).over(by_date())
    d = pick(obs, series).select(DATE, SID, VAL, prev.alias("prev_value"))
    return d.select(DATE, SID, VAL, "prev_value",
                    (F.col(VAL) - F.col("prev_value")).alias("daily_change"),
                    X.direction(VAL, "prev_value").alias("direction"))


def next_value(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    return pick(obs, series).select(DATE, SID, VAL, F.lead(VAL).over(by_date()).alias("next_val"))


def rising_flag(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """1 when the value rose against the previous observation, else 0 (first row 0)."""
    prev = F.lag(VAL).over(by_date())
    return pick(obs, series).select(DATE, SID, VAL, X.flag(F.col(VAL) > prev).alias("flag"))


def date_gaps(obs: DataFrame, series: list[str] | None = None, min_gap: int = 1) -> DataFrame:
    """Consecutive observations more than ``min_gap`` days apart."""
    d = pick(obs, series).select(SID, F.col(DATE).alias("next_date"),
                                 F.lag(DATE).over(by_date()).alias("prev_date"))
    gap = F.datediff("next_date", "prev_date").cast("bigint")
    return (d.where(F.col("prev_date").isNotNull() & (gap > min_gap))
            .select(SID, "next_date", "prev_date", gap.alias("gap_days")))


def repeated_values(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Consecutive observations with the same value."""
    w = by_date()
    d = pick(obs, series).select(SID, DATE, VAL, F.lag(VAL).over(w).alias("_pv"),
                                 F.lag(DATE).over(w).alias("prev_date"))
    return (d.where(F.col(VAL) == F.col("_pv"))
            .select(SID, F.col(DATE).alias("next_date"), "prev_date", VAL))


# --- running and moving statistics -----------------------------------------

def running_total(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    w = by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return pick(obs, series).select(DATE, SID, VAL,
                                    F.sum(VAL).over(w).cast("decimal(38,4)").alias("running_total"))


def running_count(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    return pick(obs, series).select(SID, DATE, VAL,
                                    F.row_number().over(by_date()).cast("bigint").alias("running_count"))


def moving_avg_full(obs: DataFrame, series: list[str] | None = None, n_rows: int = 7) -> DataFrame:
    """``n_rows`` average only where the frame is full."""
    w = rows_back(n_rows - 1)
    d = pick(obs, series).select(DATE, SID, VAL, moving_avg(n_rows).alias("avg_7d"),
                                 F.count(F.lit(1)).over(w).alias("_n"))
    return d.where(F.col("_n") == n_rows).drop("_n")


def moving_avg_partial(obs: DataFrame, series: list[str] | None = None, n_rows: int = 7) -> DataFrame:
    """``n_rows`` average, short frames at the start kept."""
    return pick(obs, series).select(DATE, SID, VAL, moving_avg(n_rows).alias("seven_day_ma"))


def below_moving_avg(obs: DataFrame, series: list[str] | None = None, n_rows: int = 7) -> DataFrame:
    """Flag days whose value is below their own moving average (one window, used twice)."""
    d = moving_avg_partial(obs, series, n_rows)
    return d.select(DATE, SID, VAL, "seven_day_ma",
                    X.flag(F.col(VAL) < F.col("seven_day_ma")).alias("flag"))


def moving_stddev(obs: DataFrame, series: list[str] | None = None, n_rows: int = 5) -> DataFrame:
    """Sample standard deviation over the last ``n_rows`` rows (one row -> NULL), 6 dp."""
    sd = F.stddev_samp(VAL).over(rows_back(n_rows - 1))
    return pick(obs, series).select(DATE, SID, VAL, F.round(sd.cast("double"), 6).alias("moving_stddev"))


# --- ranks, quantiles, top-n -----------------------------------------------

def quartile(obs: DataFrame, series: list[str] | None = None, buckets: int = 4) -> DataFrame:
    """NTILE(buckets) by value within each series (date breaks ties)."""
    w = Window.partitionBy(SID).orderBy(F.col(VAL).asc_nulls_last(), F.col(DATE).asc())
    return pick(obs, series).select(SID, VAL, DATE, F.ntile(buckets).over(w).cast("bigint").alias("quartile"))


def percent_rank(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(SID).orderBy(F.col(VAL).asc_nulls_last())
    return pick(obs, series).select(SID, DATE, VAL, F.percent_rank().over(w).alias("pct_rank"))


def top_n_per_series(obs: DataFrame, n: int = 3, series: list[str] | None = None) -> DataFrame:
    """The ``n`` highest values of each series (row_number, ties by date).

    Spark plans ``row_number() <= n`` as a WindowGroupLimit before and after
    the shuffle, so at most n rows per series and map task are shuffled.
    """
    rn = F.row_number().over(by_value_desc()).cast("bigint")
    d = pick(obs, series).select(rn.alias("rn"), SID, VAL, DATE)
    return d.where(F.col("rn") <= n)


def nth_highest(obs: DataFrame, n: int, series: list[str] | None = None) -> DataFrame:
    """The row ranked exactly ``n`` by value; series with fewer rows give none."""
    rn = F.row_number().over(by_value_desc()).cast("bigint")
    d = pick(obs, series).select(rn.alias("rn"), SID, VAL, DATE)
    return d.where(F.col("rn") == n)


def second_highest(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    return nth_highest(obs, 2, series)


def third_highest(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    return nth_highest(obs, 3, series).select(SID, DATE, VAL)


def number_rows(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """1..N by date within each series (the recursive-CTE numbering, without recursion)."""
    return pick(obs, series).select(SID, DATE, VAL,
                                    F.row_number().over(by_date()).cast("bigint").alias("row_num"))


def year_over_year(obs: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Yearly average per series and the previous *present* year's average."""
    y = (pick(obs, series).groupBy(SID, X.year().alias("year"))
         .agg(X.exact_avg(VAL).alias("avg_yield")))
    w = Window.partitionBy(SID).orderBy("year")
    return y.select("year", SID, "avg_yield", F.lag("avg_yield").over(w).alias("prev_year_avg_yield"))
