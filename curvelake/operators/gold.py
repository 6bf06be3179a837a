"""Gold datasets: pivoted curves, credit stress, the daily snapshot and the
filing summary.

Pivots are conditional aggregates grouped by date: one scan, a partial
(map-side) aggregate, one shuffle on ``observation_date`` and a final
aggregate.  A hot date cannot skew the shuffle because partial aggregation
leaves at most one row per (date, map task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.functions import exprs as X


def pivot_columns(mapping: dict[str, str]) -> list[Column]:
    """``MAX(CASE WHEN series_id = <id> THEN value END) AS <alias>`` per entry."""
    return [F.max(F.when(F.col("series_id") == sid, F.col("value"))).alias(alias)
            for alias, sid in mapping.items()]


def pivot_series(obs: DataFrame, mapping: dict[str, str], key: str = "observation_date") -> DataFrame:
    """Long -> wide: one row per ``key``, one column per mapped series."""
    return obs.groupBy(key).agg(*pivot_columns(mapping))


def yield_curve(obs: DataFrame) -> DataFrame:
    """2y / 10y / 30y yields and the 2s10s spread for every date in ``obs``."""
    return finish_yield_curve(pivot_series(obs, S.YIELD_CURVE_TENORS))


def finish_yield_curve(p: DataFrame) -> DataFrame:
    """The dataset from its pivoted columns (as for the other ``finish`` functions)."""
    return p.select("observation_date", "yield_2y", "yield_10y", "yield_30y",
                    (F.col("yield_10y") - F.col("yield_2y")).alias("spread_2s10s"))


def full_yield_curve(obs: DataFrame) -> DataFrame:
    """Ten treasury tenors plus 2s10s and 3m10y spreads; treasury rows only."""
    t = obs.where(F.col("series_id").startswith(S.TREASURY_PREFIX))
    return finish_full_curve(pivot_series(t, S.FULL_CURVE_TENORS))


def finish_full_curve(p: DataFrame) -> DataFrame:
    return p.select("observation_date", *S.FULL_CURVE_TENORS.keys(),
                    (F.col("yield_10y") - F.col("yield_2y")).alias("spread_2s10s"),
                    (F.col("yield_10y") - F.col("yield_3m")).alias("spread_3m10y"))


def credit_stress(obs: DataFrame) -> DataFrame:
    """Four stress legs and the combined score, for every date in ``obs``."""
    return finish_stress(pivot_series(obs, S.STRESS_LEGS))


def finish_stress(p: DataFrame) -> DataFrame:
    return p.select("observation_date", *S.STRESS_LEGS.keys(),
                    X.stress_score("hy_spread", "vix").alias("stress_score"))


def daily_snapshot(obs: DataFrame) -> DataFrame:
    """Curve ⟕ stress on date, with curve and stress labels.

    Written as ONE aggregate instead of two pivots and a join: the curve side
    keeps the dates that have a treasury row, and the stress side has a row
    for every date, so the left join never misses and the legs can be taken
    from the same grouped pass.  One scan, one shuffle.
    """
    return finish_snapshot(obs.groupBy("observation_date").agg(
        *pivot_columns(SNAPSHOT_COLUMNS), F.bool_or(F.col("series_id").startswith(S.TREASURY_PREFIX)).alias("_treasury"))
        .where(F.col("_treasury")))


SNAPSHOT_COLUMNS = {"yield_2y": S.FULL_CURVE_TENORS["yield_2y"], "yield_10y": S.FULL_CURVE_TENORS["yield_10y"],
                    "hy_spread": S.STRESS_LEGS["hy_spread"], "vix": S.STRESS_LEGS["vix"]}


def finish_snapshot(p: DataFrame) -> DataFrame:
    spread = F.col("yield_10y") - F.col("yield_2y")
    score = X.stress_score("hy_spread", "vix")
    return p.select(
        "observation_date", "yield_2y", "yield_10y",
        spread.alias("spread_2s10s"), "hy_spread", "vix", score.alias("stress_score"),
        X.curve_status(spread).alias("curve_status"),
        X.stress_level(score).alias("stress_level"),
    )


def daily_snapshot_composed(obs: DataFrame) -> DataFrame:
    """The same result written as the composition of the two gold views."""
    y = full_yield_curve(obs)
    s = credit_stress(obs)
    j = y.join(s, "observation_date", "left")
    return j.select(
        "observation_date", "yield_2y", "yield_10y", "spread_2s10s", "hy_spread", "vix",
        "stress_score", X.curve_status("spread_2s10s").alias("curve_status"),
        X.stress_level("stress_score").alias("stress_level"))


def filings_summary(fil: DataFrame, comp: DataFrame) -> DataFrame:
    """Per company: filing counts by form and the first/last filing date.

    Filings are aggregated per padded cik *before* the join (partial
    aggregation absorbs a company with a huge share of filings), then the
    one-row-per-cik result is joined to the company table on the zero-stripped
    cik.  Grouping by the padded cik after the join gives the same groups,
    because a cik matches at most one company (cik is the company key).
    """
    return finish_filings(filings_per_cik(fil), comp)


def filings_per_cik(fil: DataFrame) -> DataFrame:
    return fil.groupBy("cik").agg(
        F.count(F.lit(1)).alias("total_filings"),
        F.count_if(F.col("filing_type") == S.FORM_ANNUAL).alias("annual_reports"),
        F.count_if(F.col("filing_type") == S.FORM_QUARTERLY).alias("quarterly_reports"),
        F.count_if(F.col("filing_type") == S.FORM_CURRENT).alias("current_reports"),
        F.min("filing_date").alias("earliest_filing"),
        F.max("filing_date").alias("latest_filing"),
    )


def finish_filings(per_cik: DataFrame, comp: DataFrame) -> DataFrame:
    c = comp.select(F.col("cik").alias("_c_cik"), "ticker", F.col("name").alias("company_name"))
    j = per_cik.join(c, X.strip_leading_zeros(per_cik["cik"]) == c["_c_cik"], "inner")
    return j.select("ticker", "company_name", "cik", "total_filings", "annual_reports",
                    "quarterly_reports", "current_reports", "earliest_filing", "latest_filing")
