"""Fixtures: tables rendered as the documents that a fetch lands in bronze.

Used by the registered queries, the bench and the tests only, so that loads have documents
whose number and content follow the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.sources.bronze import ENTITY


def render_observation_docs(rows: DataFrame, ingest_date: Column | None = None) -> DataFrame:
    """(series_id, date STRING, value STRING) -> one document per series and
    year: (entity_id, ingest_date, doc).  A document never holds more than a
    year of one series."""
    o = F.struct(F.col("date"), F.col("value"))
    g = (rows.groupBy("series_id", F.substring("date", 1, 4).alias("_y"))
         .agg(F.array_sort(F.collect_list(o)).alias("observations")))
    return g.select(F.col("series_id").alias(ENTITY),
                    (ingest_date if ingest_date is not None else F.lit(None).cast("date")).alias("ingest_date"),
                    F.to_json(F.struct("observations")).alias("doc"))


def render_filing_docs(fil: DataFrame, ingest_date: Column | None = None,
                       short_form: Column | None = None, chunk: Column | None = None) -> DataFrame:
    """Filings -> submissions documents, one per (cik, filing day, chunk).

    ``chunk`` splits a company-day into documents of bounded size; the
    default is blocks of 1000 consecutive sequence numbers taken from the
    accession number (unique), so no document ever holds more than 1000
    filings, however many one company files in a day.
    ``short_form`` (a boolean column over the group) drops the last ``form``
    entry of that document, producing unequal arrays."""
    if chunk is None:
        chunk = F.floor(F.substring_index("accession_number", "-", -1).cast("bigint") / 1000)
    item = F.struct("accession_number", "filing_type", "filing_date")
    g = (fil.groupBy("cik", "company_name", "filing_date", chunk.alias("_chunk"))
         .agg(F.array_sort(F.collect_list(item)).alias("_items")))
    forms = F.transform("_items", lambda x: x["filing_type"])
    if short_form is not None:
        forms = F.when(short_form, F.slice(forms, 1, F.size("_items") - 1)).otherwise(forms)
    recent = F.struct(
        F.transform("_items", lambda x: x["accession_number"]).alias("accessionNumber"),
        forms.alias("form"),
        F.transform("_items", lambda x: F.date_format(x["filing_date"], "yyyy-MM-dd")).alias("filingDate"))
    doc = F.struct(F.col("cik"), F.col("company_name").alias("name"),
                   F.struct(recent.alias("recent")).alias("filings"))
    return g.select(F.col("cik").alias(ENTITY),
                    (ingest_date if ingest_date is not None else F.lit(None).cast("date")).alias("ingest_date"),
                    F.to_json(doc).alias("doc"))


def render_company_directory(entries: DataFrame, chunk: int = 1000) -> DataFrame:
    """(order BIGINT, cik_str BIGINT, ticker, title) -> directory documents of
    at most ``chunk`` entries each, keyed by row number as strings."""
    e = entries.withColumn("_chunk", F.floor(F.col("order") / chunk))
    g = e.groupBy("_chunk").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("order").cast("string"),
        F.struct(F.col("cik_str"), F.col("ticker"), F.col("title"))))).alias("m"))
    return g.select(F.concat(F.lit("tickers-"), F.lpad(F.col("_chunk").cast("string"), 12, "0")).alias(ENTITY),
                    F.to_json("m").alias("doc"))


def land_files(docs: DataFrame, root: str, source: str) -> None:
    """(entity_id, ingest_date, doc) -> ``<root>/<source>/<day>/<entity>.json``, one file per
    document, as other tools land them; files are written by the tasks that hold the rows."""

    def write(rows) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root if ":" in root else f"file://{root}")
        for r in rows:
            folder = f"{base}/{source}/{r.ingest_date.isoformat()}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{r[ENTITY]}.json") as f:
                f.write(r["doc"].encode())

    docs.select(ENTITY, "ingest_date", "doc").foreachPartition(write)
