"""Keyed writes that Spark's Parquet tables do not have: insert-if-absent,
upsert, flag updates and key / null / length constraints.

All are joins and aggregates, so they run distributed:

* first-wins / last-wins de-duplication is ``min_by`` / ``max_by`` over an
  explicit order (never ``dropDuplicates``, which keeps an arbitrary row);
  being aggregates, they combine map-side before the shuffle;
* insert-if-absent is a ``left_anti`` join of the batch against the target's
  key columns only (column pruning keeps that shuffle narrow);
* upsert is a full outer join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def dedupe(df: DataFrame, key: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by ``order``; order columns are
    dropped from the result.

    With one payload column and one order column this is ``min_by(col, ord)``
    over fixed-width buffers, which Spark runs as a hash aggregate; otherwise
    the payload travels as a struct (sort-based aggregate).
    """
    payload = [c for c in df.columns if c not in key and c not in order]
    pick = F.min_by if keep == "first" else F.max_by
    o = F.col(order[0]) if len(order) == 1 else _order(order)
    if len(payload) == 1:
        return df.groupBy(*key).agg(pick(F.col(payload[0]), o).alias(payload[0]))
    g = df.groupBy(*key).agg(pick(F.struct(*payload), o).alias("_row"))
    return g.select(*key, *[F.col(f"_row.{c}").alias(c) for c in payload])


def insert_if_absent(batch: DataFrame, target: DataFrame, key: list[str],
                     order: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``target`` (first one wins
    inside the batch when ``order`` is given).  Revised values for an existing
    key are ignored, as with ``INSERT … ON CONFLICT DO NOTHING``.
    ``null_safe`` matches NULL key parts to NULL (for logs whose identity may
    contain NULLs)."""
    b = dedupe(batch, key, order) if order else batch
    if not null_safe:
        return b.join(target.select(*key), key, "left_anti")
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in key])
    cond = None
    for k in key:
        c = b[k].eqNullSafe(t[f"_t_{k}"])
        cond = c if cond is None else cond & c
    return b.join(t, cond, "left_anti")


def merge_insert_if_absent(target: DataFrame, batch: DataFrame, key: list[str],
                           order: list[str] | None = None) -> DataFrame:
    """The resulting table: target plus the absent rows of the batch."""
    new = insert_if_absent(batch, target, key, order)
    return target.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: list[str], update: list[str],
           defaults: dict[str, Column] | None = None, order: list[str] | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT (key) DO UPDATE SET <update> = EXCLUDED.<update>``.

    * the source is reduced to its last row per key by ``order``; without an order a key
      that the source holds twice aborts the query (which row is last would be undefined);
    * a matched key takes the source's ``update`` columns (a NULL in the source
      is written as NULL) and keeps every other target column;
    * a new key takes the source's columns and ``defaults`` for the rest.
    """
    defaults = defaults or {}
    if order:
        s = dedupe(source, key, order, keep="last")
    else:
        g = source.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*update)).alias("_row"))
        one = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit("duplicate key in upsert source")))
        s = g.withColumn("_row", one).select(*key, *[F.col(f"_row.{c}").alias(c) for c in update])
    s = s.select(*key, *update, F.lit(True).alias("_in_src"))
    t = target.select(*target.columns, F.lit(True).alias("_in_tgt"))
    j = t.alias("t").join(s.alias("s"), key, "full_outer")
    in_src = F.col("_in_src").isNotNull()
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.col(c))
        elif c in update:
            out.append(F.when(in_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            dflt = defaults.get(c, F.lit(None))
            out.append(F.when(F.col("_in_tgt").isNotNull(), F.col(f"t.{c}"))
                       .otherwise(dflt.cast(target.schema[c].dataType)).alias(c))
    return j.select(*out)


def insert_rows(target: DataFrame, rows: DataFrame, key: list[str],
                defaults: dict[str, Column] | None = None) -> DataFrame:
    """Plain INSERT into a keyed table: appends ``rows`` (missing columns from
    ``defaults``); a key that already exists, or comes twice in ``rows``, is a violation and
    raises."""
    defaults = defaults or {}
    cols = [F.col(c) if c in rows.columns else defaults.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns]
    r = rows.select(*cols)
    dups = r.join(target.select(*key), key, "left_semi").select(F.count(F.lit(1))).scalar()
    twice = r.groupBy(*key).count().where("count > 1").select(F.count(F.lit(1))).scalar()
    # a key already present aborts the query, like a primary-key violation
    ok = F.when((dups == 0) & (twice == 0), F.lit(True)).otherwise(F.raise_error(F.lit("duplicate key on insert")))
    return target.unionByName(r).where(ok)


def set_flag(df: DataFrame, flag: str, value: bool, where: Column | None = None) -> DataFrame:
    """``UPDATE t SET flag = value [WHERE cond]``: a projection, NULL-safe
    (a row whose condition is NULL is left alone)."""
    new = F.lit(value)
    if where is not None:
        new = F.when(F.coalesce(where, F.lit(False)), F.lit(value)).otherwise(F.col(flag))
    return df.withColumn(flag, new)


def set_flag_where_in(df: DataFrame, flag: str, value: bool, column: str, values: list) -> DataFrame:
    return set_flag(df, flag, value, F.col(column).isin(list(values)))
