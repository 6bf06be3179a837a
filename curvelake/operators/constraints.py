"""Declared constraints of the stored tables, compiled from their schemas.

``schemas.TABLES`` says per table which columns may not be NULL, how long strings may be and what the
key is.  From this one declaration come

* ``broken_row``: a column that names the first constraint a row breaks, for loads (the row is rejected);
* ``guarded``: the same as an error when such a row is computed, for inserts and updates;
* ``suite``: quality rules, so that ``check`` counts all violations, duplicate keys too, in one grouped
  pass, whatever the number of constraints; ``enforce`` raises.  Every config write goes through it
  before it becomes visible.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.operators import quality as Q


@dataclass(frozen=True)
class Constraint:
    kind: str                   # NOT NULL | VARCHAR | PRIMARY KEY
    columns: tuple[str, ...]
    limit: int | None = None

    @property
    def name(self) -> str:
        kind = f"VARCHAR({self.limit})" if self.limit else self.kind
        return f"{kind} ({', '.join(self.columns)})"


class ConstraintError(RuntimeError):
    pass


def declared(table: str) -> list[Constraint]:
    """The constraints of a table: not null, lengths, then the key."""
    schema, key = S.TABLES[table]
    needed = [Constraint("NOT NULL", (f.name,)) for f in schema.fields if not f.nullable]
    lengths = [Constraint("VARCHAR", (c,), n) for c, n in S.MAX_LENGTHS[table].items()]
    return [*needed, *lengths, Constraint("PRIMARY KEY", tuple(key))]


def _breaks(c: Constraint) -> Column:
    column = F.col(c.columns[0])
    return column.isNull() if c.kind == "NOT NULL" else F.coalesce(F.length(column) > c.limit, F.lit(False))


def broken_row(table: str, kinds: tuple[str, ...] = ("NOT NULL", "VARCHAR")) -> Column:
    """The name of the first constraint of one row that it breaks, or NULL."""
    return F.coalesce(*[F.when(_breaks(c), F.lit(c.name)) for c in declared(table) if c.kind in kinds], F.lit(None).cast("string"))


def guarded(df: DataFrame, table: str) -> DataFrame:
    """``df`` as it is; a row that breaks a constraint of one row is an error when it is computed."""
    broken = broken_row(table)
    text = F.concat(F.lit(f"{table}: "), broken, F.lit(" violated by "), F.to_json(F.struct(*df.columns)))
    return df.where(F.when(broken.isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def suite(table: str) -> list[Q.Expectation]:
    """The constraints as quality rules."""
    rules = {"NOT NULL": lambda c: Q.expect_not_null(c.columns[0]), "VARCHAR": lambda c: Q.expect_max_length(c.columns[0], c.limit),
             "PRIMARY KEY": lambda c: Q.expect_unique_key(list(c.columns))}
    return [rules[c.kind](c) for c in declared(table)]


def check(df: DataFrame, table: str) -> DataFrame:
    """(constraint, rows, violations): one row per declared constraint, from one pass over ``df``."""
    names = F.create_map(*[F.lit(x) for c, e in zip(declared(table), suite(table), strict=True) for x in (f"{e.kind} {e.column}", c.name)])
    return Q.run_suite(df, suite(table)).select(
        names[F.concat_ws(" ", "expectation", "column")].alias("constraint"), F.col("element_count").alias("rows"),
        F.col("unexpected_count").alias("violations"))


def enforce(df: DataFrame, table: str) -> None:
    """Raise if ``df`` breaks a constraint; collects one row per constraint."""
    broken = [f"{r.constraint}: {r.violations} of {r.rows} rows" for r in check(df, table).collect() if r.violations != 0]
    if broken:
        raise ConstraintError(f"{table}: " + "; ".join(broken))
