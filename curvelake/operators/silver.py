"""Bronze -> silver: typing, rejects, first-wins de-duplication and the
insert-if-absent merge, for observations and filings; the company directory
upsert.

Rules carried over from the source loaders:

* observation value ``"."`` means missing: the row is dropped (not rejected);
* values are DECIMAL(10,4) rounded half-up; a value that does not parse or
  overflows is a *reject* (the source raised and lost the whole document);
* the first value written for a key wins; later revisions are ignored;
* filing rows come from the accession list; a row whose form or date slot is
  missing (unequal arrays) is a reject;
* the company directory is last-wins per cik; ``is_active`` and creation
  columns are never touched by the update.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.functions import exprs as X
from curvelake.operators import constraints as C
from curvelake.operators import merge as M
from curvelake.sources import bronze as B


@dataclass
class Load:
    """Lazy result of a load: rows to append and rows rejected."""

    new_rows: DataFrame
    rejects: DataFrame
    typed: DataFrame | None = None   # every parsed row with its reject reason


def filter_missing_marker(rows: DataFrame) -> DataFrame:
    """Drop bronze observations whose value is the missing marker (before any cast)."""
    v = F.col("value")
    return rows.where(v.isNull() | (v != S.MISSING_MARKER))


def typing_observations(rows: DataFrame) -> DataFrame:
    """String rows -> typed rows with a ``reject_reason`` (NULL when good)."""
    r = filter_missing_marker(rows)
    t = r.select("series_id", "ingest_date", "doc_id", "pos",
                 X.to_iso_date("date").alias("observation_date"),
                 X.to_value("value").alias("value"),
                 F.col("date").alias("raw_date"), F.col("value").alias("raw_value"), "doc_error")
    reason = (F.when(F.col("pos").isNull(), F.lit("no observations"))
              .when(F.col("series_id").isNull() | (F.col("series_id") == ""), F.lit("no series id"))
              .when(C.broken_row("observations", ("VARCHAR",)).isNotNull(), F.lit("series id too long"))
              .when(F.col("observation_date").isNull(), F.lit("bad date"))
              .when(F.col("value").isNull(), F.lit("bad value"))
              .otherwise(C.broken_row("observations")))
    return t.withColumn("reject_reason", reason)


def split_typed_observations(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows -> (good rows, rejects)."""
    good = t.where(F.col("reject_reason").isNull()).select(
        "observation_date", "series_id", "value", "ingest_date", "doc_id", "pos")
    bad = t.where(F.col("reject_reason").isNotNull()).select(
        "series_id", "ingest_date", "doc_id", "pos", "raw_date", "raw_value", "reject_reason", "doc_error")
    return good, bad


def typed_observations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """String rows -> (typed rows, rejects).  Output typed columns:
    observation_date, series_id, value, plus ingest_date and pos for ordering."""
    return split_typed_observations(typing_observations(rows))


def observation_order():
    """First-wins order of observations as one fixed-width number: ingest day, position in
    the document, hash of the document (so that two documents of a day never tie).  The
    de-duplication then is a hash aggregate."""
    big = "decimal(38,0)"
    place = F.coalesce(F.unix_date("ingest_date"), F.lit(0)).cast("bigint") * F.lit(1 << 32) + F.col("pos").cast("bigint")
    return (place.cast("decimal(18,0)") * X.dec(1 << 64)).cast(big) + (F.col("doc_id").cast("decimal(20,0)") + X.dec(1 << 63)).cast(big)


def load_observations(parsed_docs: DataFrame, silver: DataFrame, buckets: int | None = None) -> Load:
    """Parsed observation documents + current silver -> rows to insert."""
    return load_typed_observations(typing_observations(B.observation_rows(parsed_docs)), silver, buckets)


def load_typed_observations(t: DataFrame, silver: DataFrame, buckets: int | None = None) -> Load:
    """The same from typed rows (a job stages them once for its several outputs).

    Revisions are combined before the shuffle and spread over series and date; only the one
    row left per key goes on to the bucket of its series (``buckets``: silver is bucketed by
    series_id into that many), where the anti-join needs no further exchange."""
    good, bad = split_typed_observations(t)
    g = good.select("observation_date", "series_id", "value", observation_order().alias("_ord"))
    first = M.dedupe(g, S.OBSERVATIONS_KEY, ["_ord"])
    if buckets:
        first = first.repartition(buckets, F.col("series_id"))
    new = M.insert_if_absent(first, silver, S.OBSERVATIONS_KEY)
    return Load(new.select("observation_date", "series_id", "value"), bad, t)


def typing_filings(rows: DataFrame) -> DataFrame:
    """Filing rows -> typed rows with a ``reject_reason`` (NULL when good)."""
    t = rows.select("accession_number", "cik", "company_name",
                    F.col("form").alias("filing_type"),
                    X.to_iso_date("filing_date_str").alias("filing_date"),
                    "filing_date_str", "complete", "ingest_date", "doc_id", "pos", "doc_error")
    missing = F.col("accession_number").isNull() | (F.col("accession_number") == "")
    reason = (F.when(F.col("pos").isNull(), F.lit("no filings"))
              .when(missing, F.lit("no accession number"))
              .when(C.broken_row("filings", ("VARCHAR",)).isNotNull(), F.lit("value too long"))
              .when(~F.col("complete"), F.lit("unequal arrays"))
              .when(F.col("filing_date_str").isNotNull() & F.col("filing_date").isNull(), F.lit("bad date"))
              .otherwise(C.broken_row("filings")))
    return t.withColumn("reject_reason", reason)


def split_typed_filings(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = t.where(F.col("reject_reason").isNull()).select(
        "accession_number", "cik", "company_name", "filing_type", "filing_date", "ingest_date", "doc_id", "pos")
    bad = t.where(F.col("reject_reason").isNotNull()).select(
        "accession_number", "cik", "ingest_date", "doc_id", "pos", "reject_reason", "doc_error")
    return good, bad


def typed_filings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_typed_filings(typing_filings(rows))


def load_filings(parsed_docs: DataFrame, silver: DataFrame, buckets: int | None = None) -> Load:
    """Parsed filing documents + current silver -> rows to insert."""
    return load_typed_filings(typing_filings(B.filing_rows(parsed_docs)), silver, buckets)


def load_typed_filings(t: DataFrame, silver: DataFrame, buckets: int | None = None) -> Load:
    """The same from typed rows (see ``load_typed_observations``; silver is bucketed by
    ``accession_number``, which is also the key, so one shuffle does for both)."""
    good, bad = split_typed_filings(t)
    # cik is both part of the order and of the row
    first = M.dedupe(good.withColumn("_c", F.col("cik")), S.FILINGS_KEY, ["ingest_date", "_c", "pos", "doc_id"])
    if buckets:
        first = first.repartition(buckets, F.col("accession_number"))
    new = M.insert_if_absent(first, silver, S.FILINGS_KEY)
    return Load(new.select(*[f.name for f in S.FILINGS.fields]), bad, t)


def error_documents(parsed_docs: DataFrame, payload: str = "observations") -> DataFrame:
    """Documents without a payload (failed fetches stored as documents)."""
    return parsed_docs.where(F.col(payload).isNull())


def company_updates(directory_rows: DataFrame) -> DataFrame:
    """Directory rows -> one (cik, ticker, name) per cik, the last one written: by the day it
    was fetched, the file, the position in it."""
    return M.dedupe(directory_rows.select("cik", "ticker", "name", "fetched", "doc", "pos"),
                    ["cik"], ["fetched", "doc", "pos"], keep="last")


def upsert_companies(companies: DataFrame, directory_rows: DataFrame) -> DataFrame:
    """Insert new companies (active by default), update ticker and name of known ones; a row that
    breaks a declared constraint is an error."""
    return C.guarded(M.upsert(companies, company_updates(directory_rows), S.COMPANIES_KEY, ["ticker", "name"],
                              defaults=_new_row(companies)), "companies")


def upsert_series(series: DataFrame, updates: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Insert or update name and category per series id; the last row by ``order`` (columns
    of ``updates``) wins, and without an order an id must not come twice; a row that breaks a
    declared constraint is an error."""
    u = updates.select("series_id", "name", "category", *(order or []))
    return C.guarded(M.upsert(series, u, S.SERIES_KEY, ["name", "category"], defaults=_new_row(series), order=order), "series")


def insert_config_rows(config: DataFrame, rows: DataFrame, table: str) -> DataFrame:
    """Plain INSERT into a config table (active by default); a key that is there, or a row that breaks a
    declared constraint, is an error."""
    return C.guarded(M.insert_rows(config, rows, S.TABLES[table][1], _new_row(config)), table)


def _new_row(table: DataFrame) -> dict:
    """What a new config row starts with; an update leaves both alone."""
    out = {"is_active": F.lit(True)}
    if "created_at" in table.columns:
        out["created_at"] = F.current_timestamp()
    return out
