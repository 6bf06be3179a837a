"""Scalar helpers built only from Spark's built-in expressions (codegen-able)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from curvelake import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(x: str | int | float) -> Column:
    """An exact decimal literal (compares without a detour through double)."""
    return F.lit(Decimal(str(x)))


def strip_leading_zeros(c: str | Column) -> Column:
    """``LTRIM(s, '0')``.  Note that Spark SQL's two-argument LTRIM takes the
    trim string *first*; the Column API below has the usual order."""
    return F.ltrim(col(c), F.lit("0"))


def zfill(c: str | Column, width: int) -> Column:
    """Python's ``str.zfill`` for digit strings: pad to ``width`` with zeros
    but never cut a longer value (``lpad`` alone would truncate it)."""
    s = col(c)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def to_value(c: str | Column) -> Column:
    """Bronze value string -> DECIMAL(10,4); NULL when not castable or out of
    range (the caller routes those rows to rejects)."""
    return col(c).try_cast(S.VALUE_TYPE)


def to_iso_date(c: str | Column) -> Column:
    """ISO ``yyyy-MM-dd`` string -> DATE, NULL when malformed."""
    return F.try_to_date(col(c), "yyyy-MM-dd") if hasattr(F, "try_to_date") \
        else col(c).try_cast("date")


def exact_avg(c: str | Column) -> Column:
    """Average as ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``: the decimal sum is
    exact, so the result is the same double on every engine."""
    return col_sum(c).cast("double") / F.count(col(c))


def col_sum(c: str | Column) -> Column:
    return F.sum(col(c))


def direction(value: str | Column, prev: str | Column) -> Column:
    v, p = col(value), col(prev)
    return (F.when(p.isNull(), F.lit("N/A"))
            .when(v > p, F.lit("positive"))
            .when(v < p, F.lit("negative"))
            .otherwise(F.lit("zero")))


def curve_status(spread: str | Column) -> Column:
    s = col(spread)
    return (F.when(s < dec(S.CURVE_INVERTED_BELOW), F.lit("INVERTED"))
            .when(s < dec(S.CURVE_FLAT_BELOW), F.lit("FLAT"))
            .otherwise(F.lit("NORMAL")))


def stress_level(score: str | Column) -> Column:
    s = col(score)
    return (F.when(s > dec(S.STRESS_HIGH_ABOVE), F.lit("HIGH"))
            .when(s > dec(S.STRESS_ELEVATED_ABOVE), F.lit("ELEVATED"))
            .otherwise(F.lit("LOW")))


def stress_score(hy: str | Column, vix: str | Column) -> Column:
    """``round(coalesce(hy,0)/10 + coalesce(vix,0)/40, 2)`` in exact decimal
    arithmetic, returned as DECIMAL(18,2)."""
    h = F.coalesce(col(hy), dec(0))
    v = F.coalesce(col(vix), dec(0))
    raw = h / dec(f"{S.STRESS_HY_DIVISOR}.0") + v / dec(f"{S.STRESS_VIX_DIVISOR}.0")
    return F.round(raw, 2).cast("decimal(18,2)")


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def year(c: str | Column = "observation_date") -> Column:
    return F.year(col(c)).cast("bigint")


def month(c: str | Column = "observation_date") -> Column:
    return F.month(col(c)).cast("bigint")


def literal_rows(spark, rows: list[tuple], schema) -> "DataFrame":
    """A small literal table built inside the JVM (``inline(array(struct…))``),
    without shipping Python objects through Python workers."""
    from pyspark.sql.types import DataType

    if isinstance(schema, str):
        schema = DataType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
