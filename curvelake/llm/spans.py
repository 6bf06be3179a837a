"""Places of regular expressions in texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: one place: 0-based code points, end exclusive
SPAN = "struct<start:long,end:long,match:string>"


def matches(text: Column, regex: str, may: Column | None = None) -> Column:
    """All leftmost non-overlapping matches as strings; ``may``: a cheap test that every text
    with a match passes."""
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    none = F.array().cast("array<string>")
    return F.coalesce(found if may is None else F.when(may, found).otherwise(none), none)


def places(text: Column, regex: str, found: Column) -> Column:
    """array<SPAN> of the matches ``found``: what lies between them is what split() leaves."""
    gaps = F.transform(F.split(text, regex, -1), F.length)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        end = begin + F.length(pair["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(
        F.array().cast(f"array<{SPAN}>"))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, then end, comma-joined (array of structs
    kind, start, end)."""
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("nth"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: str) -> Column:
    """SPAN places as (kind, start, end, match)."""
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                 s["end"].alias("end"), s["match"].alias("match")))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def bare(spans: Column) -> Column:
    """Spans as (kind, start, end)."""
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
