"""Whole-table RANK / DENSE_RANK without a single-partition window.

``rank() OVER (ORDER BY x)`` with no PARTITION BY makes Spark move every row into one task.
Instead:

1. rows are counted per value (combined before the shuffle, so ties cost one row however
   many they are);
2. approximate quantiles of the values, one scalar subquery, cut them into at most RANGES
   ranges.  Quantiles only balance the ranges: a value's range follows from a binary search in them;
3. values are ranked inside their range, and each range is offset by the rows and the values
   of all earlier ones, a table of at most RANGES rows;
4. the ranks are joined back to the rows by value.

Nothing is computed before the result is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 1000
STEPS = [1 << k for k in range(RANGES.bit_length() - 1, -1, -1)]


def global_rank(df: DataFrame, key: str, descending: bool = True,
                rank_col: str = "rank", dense_col: str = "dense_rank") -> DataFrame:
    order = F.col("_v").desc_nulls_first() if descending else F.col("_v").asc_nulls_last()
    values = df.groupBy(F.col(key).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = values.agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], 10 * RANGES)).scalar()
    # binary search: how many cuts, of at most 2 * STEPS[0] - 1, are below the value
    below = F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), lambda at, step: F.when(
        F.get("_cuts", at + step - 1) < F.col("_v"), at + step).otherwise(at))
    part = F.when(F.col("_v").isNull(), F.lit(RANGES)).otherwise(F.coalesce(below, F.lit(0)))
    ranged = values.withColumn("_cuts", cuts).withColumn("_range", part).drop("_cuts")
    first = F.col("_range").desc() if descending else F.col("_range").asc()
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES + 1 rows
    offsets = (ranged.groupBy("_range").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
               .select(F.col("_range").alias("_r"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
                       F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_values_before")))
    ranked = (ranged.withColumn("_rows_to", F.sum("_n").over(inside)).withColumn("_nth", F.row_number().over(inside))
              .join(offsets, F.col("_range") == F.col("_r"))
              .select("_v", (F.col("_rows_before") + F.col("_rows_to") - F.col("_n") + 1).cast("bigint").alias(rank_col),
                      (F.col("_values_before") + F.col("_nth")).cast("bigint").alias(dense_col)))
    return df.join(ranked, df[key].eqNullSafe(F.col("_v"))).drop("_v")
