"""Data-quality expectations, run as one pass, and a blocking gate.

Each expectation yields one result row::

    expectation, column, element_count, unexpected_count, unexpected_percent, success

All rules are evaluated in ONE scan however many there are: the row-level
rules (not-null, regex, max length) are counted inside the grouped aggregate
that key uniqueness needs anyway (partial + final, so a hot key is combined
map-side), then summed.  Column existence is read from the schema (no job).
The gate collects only the result rows (one per rule) and raises.

With ``samples`` every row also carries that many unexpected values, from the same pass and from
buffers of fixed size: a top-k sketch of at most TRACKED values per rule, and, for when too many values
are equally rare, the least value of each of SLOTS hash slots.  A bad value that a third of all rows
hold, or a million different ones, take no more room.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake import schemas as S


#: unexpected values that the sketch of a rule tracks, and those that it hands on
TRACKED, HANDED = 10_000, 1_000
SLOTS = 20


@dataclass(frozen=True)
class Expectation:
    kind: str                     # column_exists | not_null | match_regex | max_length | unique_key
    column: str                   # for unique_key: comma-joined key columns
    params: dict = field(default_factory=dict, compare=False, hash=False)


def expect_column_exists(c: str) -> Expectation:
    return Expectation("expect_column_to_exist", c)


def expect_not_null(c: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", c)


def expect_match_regex(c: str, regex: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", c, {"regex": regex})


def expect_max_length(c: str, n: int) -> Expectation:
    return Expectation("expect_column_value_lengths_to_be_at_most", c, {"max": n})


def expect_unique_key(cols: list[str]) -> Expectation:
    return Expectation("expect_compound_columns_to_be_unique", ",".join(cols), {"key": list(cols)})


def observation_suite() -> list[Expectation]:
    """The observation-table suite: 3 columns exist, 2 keys not null, the id
    format; plus the primary key and declared length Spark does not enforce."""
    return [
        expect_column_exists("series_id"),
        expect_column_exists("observation_date"),
        expect_column_exists("value"),
        expect_not_null("series_id"),
        expect_not_null("observation_date"),
        expect_match_regex("series_id", S.SERIES_ID_REGEX),
        expect_unique_key(S.OBSERVATIONS_KEY),
        expect_max_length("series_id", S.MAX_LENGTHS["observations"]["series_id"]),
    ]


def _row(e: Expectation, total: Column, unexpected: Column, denom: Column, values: Column | None = None) -> Column:
    pct = F.try_divide(unexpected.cast("double") * F.lit(100.0), denom.cast("double"))
    return F.struct(F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column"),
                    total.cast("bigint").alias("element_count"),
                    unexpected.cast("bigint").alias("unexpected_count"),
                    F.coalesce(pct, F.lit(0.0)).alias("unexpected_percent"),
                    (F.coalesce(unexpected, F.lit(0)) == 0).alias("success"),
                    *([values.alias("unexpected_values")] if values is not None else []))


def _kept_values(i: int) -> list[Column]:
    """Buffers for the values in column ``_v<i>`` of the rows where ``_b<i>`` holds."""
    slots = [F.min(F.when(F.col(f"_s{i}") == n, F.col(f"_v{i}"))) for n in range(SLOTS)]
    return [F.expr(f"approx_top_k(_v{i}, {HANDED}, {TRACKED}) FILTER (WHERE _b{i})").alias(f"_t{i}"), F.array(*slots).alias(f"_m{i}")]


def _shown(i: int, value: Column, bad: Column) -> list[Column]:
    """The columns that ``_kept_values`` reads."""
    text = value.cast("string")
    return [text.alias(f"_v{i}"), bad.alias(f"_b{i}"), F.when(bad, F.pmod(F.xxhash64(text), F.lit(SLOTS))).alias(f"_s{i}")]


def _row_counts(rules: list[Expectation], cols: set[str]) -> tuple[dict[str, Column], dict[int, Column]]:
    """The counts of the rules about one row, and which rows are unexpected where there is a value to show."""
    row_aggs: dict[str, Column] = {}
    bad: dict[int, Column] = {}          # row rules with values to show
    for i, e in enumerate(rules):
        c = F.col(e.column) if e.column in cols else None
        if c is None:
            continue
        if e.kind == "expect_column_values_to_not_be_null":
            row_aggs[f"_u{i}"] = F.count_if(c.isNull())
        elif e.kind == "expect_column_values_to_match_regex":
            bad[i] = F.coalesce(~c.rlike(e.params["regex"]), F.lit(False))
            row_aggs[f"_u{i}"] = F.count_if(bad[i])
            row_aggs[f"_d{i}"] = F.count(c)
        elif e.kind == "expect_column_value_lengths_to_be_at_most":
            bad[i] = F.coalesce(F.length(c) > e.params["max"], F.lit(False))
            row_aggs[f"_u{i}"] = F.count_if(bad[i])
            row_aggs[f"_d{i}"] = F.count(c)
    return row_aggs, bad


def run_suite(df: DataFrame, rules: list[Expectation], samples: int = 0) -> DataFrame:
    """Evaluate ``rules`` over the whole of ``df``; one row per rule, in rule order.

    ``samples`` > 0 adds ``unexpected_values``: up to that many different ones as strings, the first in
    order while there are at most HANDED; of more, frequent ones and one of each hash slot;
    empty for rules whose unexpected values are NULL or that are about no value.

    One scan: with a key-uniqueness rule, the row rules are counted per key
    in the same grouped aggregate that counts key occurrences (partial
    aggregation map-side), then summed; without one, a single global aggregate.
    """
    cols = set(df.columns)
    row_aggs, bad = _row_counts(rules, cols)
    key_rules = [(i, e) for i, e in enumerate(rules) if e.kind == "expect_compound_columns_to_be_unique"
                 and set(e.params["key"]) <= cols]

    if key_rules:
        i0, e0 = key_rules[0]
        key = e0.params["key"]
        # of a column outside the key, one unexpected value of each key goes on
        inner = {i: F.max(F.when(b, F.col(rules[i].column))) for i, b in bad.items() if samples and rules[i].column not in key}
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"), *[v.alias(k) for k, v in row_aggs.items()],
                                       *[v.alias(f"_x{i}") for i, v in inner.items()])
        if samples:
            shown = {i: F.col(f"_x{i}") if i in inner else F.col(rules[i].column) for i in bad}
            per_key = per_key.select("*", *[c for i, v in shown.items() for c in _shown(i, v, F.col(f"_u{i}") > 0)],
                                     *_shown(i0, F.to_json(F.struct(*key)), F.col("_c") > 1))
        one = per_key.agg(
            F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"),
            F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias(f"_u{i0}"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in row_aggs],
            *[c for i in ([*bad, i0] if samples else []) for c in _kept_values(i)])
        for i, e in key_rules[1:]:  # further keys: one grouped scalar subquery each
            k = df.groupBy(*e.params["key"]).agg(F.count(F.lit(1)).alias("_c"))
            one = one.withColumn(f"_u{i}", k.agg(
                F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0))).scalar())
    else:
        if samples:
            df = df.select("*", *[c for i, b in bad.items() for c in _shown(i, F.col(rules[i].column), b)])
        one = df.agg(F.count(F.lit(1)).alias("_n"), *[v.alias(k) for k, v in row_aggs.items()],
                     *[c for i in (bad if samples else ()) for c in _kept_values(i)])

    none = F.array().cast("array<string>")

    def values(i: int) -> Column | None:
        if not samples:
            return None
        if f"_t{i}" not in one.columns:
            return none
        found = F.concat(F.coalesce(F.transform(f"_t{i}", lambda t: t["item"]), none), F.array_compact(f"_m{i}"))
        return F.slice(F.array_sort(F.array_distinct(found)), 1, samples)

    return _results(one, rules, cols, {k for k in row_aggs if k.startswith("_d")}, values)


def _results(one: DataFrame, rules: list[Expectation], cols: set[str], denominators: set[str],
             values: Callable[[int], Column | None] = lambda i: None) -> DataFrame:
    """One row per rule from one row of counts (``_n`` rows, ``_u<i>`` unexpected, ``_d<i>`` not null)."""
    n = F.col("_n")
    rows = []
    for i, e in enumerate(rules):
        present = e.column in cols or (e.kind == "expect_compound_columns_to_be_unique"
                                       and set(e.params["key"]) <= cols)
        if e.kind == "expect_column_to_exist":
            rows.append(_row(e, n, F.lit(0 if present else 1), F.lit(1), values(i)))
        elif not present:
            rows.append(_row(e, n, F.lit(None).cast("bigint"), n, values(i)).withField("success", F.lit(False)))
        else:
            denom = F.col(f"_d{i}") if f"_d{i}" in denominators else n
            rows.append(_row(e, n, F.col(f"_u{i}"), denom, values(i)))
    return one.select(F.inline(F.array(*rows)))


def counts_by(df: DataFrame, rules: list[Expectation], by: str) -> DataFrame:
    """The counts behind a suite's results for each group of ``by``: they add up over groups as long as
    no key is in two of them.  The suite's rules must have one key; ``by`` is a column of ``df``."""
    row_aggs, _ = _row_counts(rules, set(df.columns))
    i, key = next((i, e.params["key"]) for i, e in enumerate(rules) if e.kind == "expect_compound_columns_to_be_unique")
    per_key = df.groupBy(by, *key).agg(F.count(F.lit(1)).alias("_c"), *[v.alias(k) for k, v in row_aggs.items()])
    return per_key.groupBy(by).agg(F.sum("_c").alias("_n"), F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias(f"_u{i}"),
                                   *[F.sum(k).alias(k) for k in row_aggs])


def add_up(counts: DataFrame, rules: list[Expectation], cols: list[str]) -> DataFrame:
    """A suite's results from ``counts_by`` rows."""
    names = [c for c in counts.columns if c[:2] in ("_u", "_d") or c == "_n"]
    one = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    return _results(one, rules, set(cols), {c for c in names if c.startswith("_d")})


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Raise when any expectation failed; otherwise return the results.

    Collects only the result rows (one per expectation)."""
    failed = [r.asDict() for r in results.where(~F.col("success")).collect()]
    if failed:
        raise QualityGateError(f"{len(failed)} expectation(s) failed: {failed}")
    return results
