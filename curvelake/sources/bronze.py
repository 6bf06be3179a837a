"""Bronze documents: raw text as fetched, any number per entity and day.

Two layouts under one root are read together:

* ``<root>/source=<fred|sec>/ingest_date=<yyyy-MM-dd>/part-*.parquet`` with columns
  ``entity_id``, ``doc`` (the body as it came, JSON or not) and ``write_id``, written by
  ``curvelake.sinks.writers.write_bronze``; of one (source, day, entity) only the documents
  of the latest write count;
* ``<root>/<source>/<yyyy-MM-dd>/<entity>.json``, one file per document, landed by other tools.

``located`` is the one place where a path becomes (source, entity, day), for batch and stream.
Bodies are parsed with an explicit schema; one that doesn't parse (an HTML error page, an
array) has no payload and is reported as an error document.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows

ENTITY = "entity_id"

# ---------------------------------------------------------------------------
# Where a document came from
# ---------------------------------------------------------------------------

#: a raw document; ``write_id`` is NULL for landed files
RAW = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField(ENTITY, T.StringType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("write_id", T.StringType()),
    T.StructField("doc", T.StringType()),
])
WRITTEN = T.StructType([T.StructField(ENTITY, T.StringType()), T.StructField("doc", T.StringType()),
                        T.StructField("write_id", T.StringType())])


def located(files: DataFrame, body: str) -> DataFrame:
    """Rows of files of either layout, with the path in ``_metadata`` -> RAW documents."""
    path = F.col("_metadata.file_path")
    day = F.regexp_extract(path, r"(?:/|ingest_date=)(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    source = F.regexp_extract(path, r"/(?:source=)?([^/=]+)/(?:ingest_date=)?\d{4}-\d{2}-\d{2}/[^/]+$", 1)
    name = F.regexp_extract(path, r"([^/]+)\.json$", 1)
    own = F.col(ENTITY) if ENTITY in files.columns else F.when(name != "", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))
    write = F.col("write_id") if "write_id" in files.columns else F.lit(None).cast("string")
    return files.select(F.when(source != "", source).alias("source"), own.alias(ENTITY),
                        F.try_to_date(day, "yyyy-MM-dd").alias("ingest_date"), write.alias("write_id"), F.col(body).alias("doc"))


def latest_writes(docs: DataFrame) -> DataFrame:
    """Documents of the latest write of each (source, day, entity); landed files stay."""
    key = ["source", "ingest_date", ENTITY]
    last = docs.where("write_id IS NOT NULL").groupBy(*key).agg(F.max("write_id").alias("_w"))
    last = last.select(*[F.col(k).alias(f"_{k}") for k in key], "_w")
    same = F.col("write_id") == F.col("_w")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    written = docs.where("write_id IS NOT NULL").join(last, same, "left_semi")
    return written.unionByName(docs.where("write_id IS NULL"))


# ---------------------------------------------------------------------------
# Parsing (shared by the file readers and the in-memory forms)
# ---------------------------------------------------------------------------


def observation_rows(docs: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Parsed observation documents -> one row per observation.

    Input columns: ``series_id``, ``ingest_date``, ``doc_id``, ``observations``.
    Output: (series_id, ingest_date, doc_id, pos, date, value) with date/value still
    strings; ``pos`` is the position in the document (first-wins order, then ``doc_id``).
    A document without ``observations`` yields no rows, or with
    ``keep_empty`` one row with NULL ``pos`` (so it can be reported).
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    e = docs.select("series_id", "ingest_date", "doc_id", _error_of(docs), explode("observations").alias("pos", "o"))
    return e.select("series_id", "ingest_date", "doc_id", "pos",
                    F.col("o.date").alias("date"), F.col("o.value").alias("value"), "doc_error")


def _error_of(docs: DataFrame) -> Column:
    return F.col("doc_error") if "doc_error" in docs.columns else F.lit(None).cast("string").alias("doc_error")


def array_len(arr: Column) -> Column:
    """Length of an array column, 0 when the array is missing (``size(NULL)``
    is NULL or -1 depending on ANSI mode)."""
    return F.when(arr.isNotNull(), F.size(arr)).otherwise(F.lit(0))


def filing_rows(docs: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Parsed filing documents -> one row per accession number.

    The three used arrays are zipped; ``arrays_zip`` pads a shorter array with
    NULL, so a row whose form/date slot is missing is *kept* here with
    ``complete = false`` (the load routes it to rejects), while slots beyond the
    accession list are dropped (the accession list drives the rows).  With
    ``keep_empty`` a document without filings gives one row with NULL ``pos``.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    r = F.col("filings.recent")
    n = array_len(r["accessionNumber"])
    def arr(name: str) -> Column:  # a missing array zips as empty (arrays_zip(NULL, …) is NULL)
        return F.coalesce(r[name], F.array().cast("array<string>"))

    z = F.arrays_zip(arr("accessionNumber").alias("a"), arr("form").alias("f"), arr("filingDate").alias("d"))
    e = docs.select(
        F.coalesce(F.col("cik"), F.col(ENTITY), F.lit("")).alias("cik"),
        F.coalesce(F.col("name"), F.lit("")).alias("company_name"),
        "ingest_date", "doc_id", _error_of(docs),
        n.alias("_n"), array_len(r["form"]).alias("_nf"), array_len(r["filingDate"]).alias("_nd"),
        explode(z).alias("pos", "z"))
    return (e.where(F.col("pos").isNull() | (F.col("pos") < F.col("_n")))
            .select("cik", "company_name", "ingest_date", "doc_id", "pos",
                    F.col("z.a").alias("accession_number"), F.col("z.f").alias("form"),
                    F.col("z.d").alias("filing_date_str"),
                    ((F.col("pos") < F.col("_nf")) & (F.col("pos") < F.col("_nd"))).alias("complete"), "doc_error"))


def ticker_rows(directory: DataFrame) -> DataFrame:
    """Parsed company directories (``map<row-number, entry>``) -> rows.

    Output: (cik un-padded string, ticker, name, fetched, doc, pos) where
    (fetched, doc, pos) is the write order used for last-wins.
    """
    e = directory.select("fetched", "doc", F.explode("entries").alias("k", "v"))
    return e.select(F.col("v.cik_str").cast("string").alias("cik"), F.col("v.ticker").alias("ticker"),
                    F.col("v.title").alias("name"), "fetched", "doc", F.col("k").cast("bigint").alias("pos"))


# ---------------------------------------------------------------------------
# File readers
# ---------------------------------------------------------------------------


def _day_glob(days: tuple | list) -> str:
    """A (first, last) tuple, or a list of days, as a path pattern."""
    if isinstance(days, tuple):
        lo, hi = days
        days = [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
    names = sorted(d.isoformat() for d in days)
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def _or_none(read):
    """The DataFrame that ``read`` gives, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def document_index(spark: SparkSession, root: str, source: str) -> DataFrame:
    """(source, entity_id, ingest_date, write_id) of every document of one source, in both layouts.
    Bodies are not read: of written files two narrow columns, of landed ones the names."""
    base = root.rstrip("/")
    written = _or_none(lambda: spark.read.schema(WRITTEN).parquet(f"{base}/source={source}/ingest_date=*"))
    landed = _or_none(lambda: spark.read.format("binaryFile").load(f"{base}/{source}/*/*.json"))
    parts = [located(files, body).drop("doc") for files, body in ((written, "doc"), (landed, "path")) if files is not None]
    if not parts:
        return literal_rows(spark, [], RAW).drop("doc")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def raw_documents(spark: SparkSession, root: str, source: str, ingest_dates: tuple | list | None = None) -> DataFrame:
    """RAW documents of one source, from both layouts; a (first, last) range of days, or a list of days,
    reads only their folders."""
    base = root.rstrip("/")
    days = _day_glob(ingest_dates) if ingest_dates is not None else "*"
    written = _or_none(lambda: spark.read.schema(WRITTEN).parquet(f"{base}/source={source}/ingest_date={days}"))
    landed = _or_none(lambda: spark.read.text(f"{base}/{source}/{days}/*.json", wholetext=True))
    parts = ([latest_writes(located(written, "doc"))] if written is not None else []) + \
        ([located(landed, "value")] if landed is not None else [])
    if not parts:
        return literal_rows(spark, [], RAW)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_observation_docs(spark: SparkSession, root: str, ingest_dates: tuple | None = None) -> DataFrame:
    """Bronze observation documents -> (series_id, ingest_date, doc_id, observations)."""
    return parse_observation_docs(raw_documents(spark, root, "fred", ingest_dates))


def read_filing_docs(spark: SparkSession, root: str, ingest_dates: tuple | None = None) -> DataFrame:
    return parse_filing_docs(raw_documents(spark, root, "sec", ingest_dates))


def read_company_directory(spark: SparkSession, path: str) -> DataFrame:
    """Company ticker directory files: each file one JSON object of objects.  ``fetched`` is
    the day in the path, or else the day the file was written."""
    t = spark.read.text(path, wholetext=True)
    day = F.try_to_date(F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1), "yyyy-MM-dd")
    return t.select(F.coalesce(day, F.to_date("_metadata.file_modification_time")).alias("fetched"),
                    F.col("_metadata.file_path").alias("doc"), F.from_json("value", S.TICKER_DIRECTORY).alias("entries"))


# ---------------------------------------------------------------------------
# In-memory forms: documents held as JSON strings in a column
# ---------------------------------------------------------------------------


NOT_JSON, NO_PAYLOAD, OTHER_PAYLOAD = "not JSON", "JSON without payload", "payload of another type"


def document_error(payload: Column, name: str) -> Column:
    """Why a document has no ``payload`` (its field ``name``); NULL if it has one.  Only documents
    without are parsed a second time, as a variant, which takes any JSON."""
    body = F.try_parse_json("doc")
    found = F.try_variant_get(body, f"$.{name}", "variant")
    return (F.when(payload.isNotNull(), F.lit(None)).when(body.isNull(), F.lit(NOT_JSON))
            .when(found.isNull() | F.is_variant_null(found), F.lit(NO_PAYLOAD)).otherwise(F.lit(OTHER_PAYLOAD)))


def document_message(path: str = "$.error_message", default: str = "") -> Column:
    """A field of a document by its path, whatever else the document holds; ``default`` without it."""
    return F.coalesce(F.try_variant_get(F.try_parse_json("doc"), path, "string"), F.lit(default))


def parse_observation_docs(docs: DataFrame) -> DataFrame:
    """(entity_id, ingest_date, doc) JSON strings -> parsed documents; ``doc_id`` is a hash
    of the body, which breaks ties of documents of one entity and day; ``doc_error`` says why a
    document has no observations."""
    p = docs.select(F.col(ENTITY).alias("series_id"), "ingest_date", F.xxhash64("doc").alias("doc_id"),
                    F.from_json("doc", S.OBSERVATION_DOC).alias("j"), "doc")
    return p.select("series_id", "ingest_date", "doc_id", "j.observations",
                    document_error(F.col("j.observations"), "observations").alias("doc_error"))


def parse_filing_docs(docs: DataFrame) -> DataFrame:
    entity = F.col(ENTITY) if ENTITY in docs.columns else F.lit(None).cast("string").alias(ENTITY)
    p = docs.select(entity, "ingest_date", F.xxhash64("doc").alias("doc_id"), F.from_json("doc", S.FILING_DOC).alias("j"), "doc")
    return p.select(ENTITY, "ingest_date", "doc_id", "j.cik", "j.name", "j.filings",
                    document_error(F.col("j.filings"), "filings").alias("doc_error"))


def parse_company_directory(docs: DataFrame) -> DataFrame:
    """(entity_id, doc[, ingest_date]) -> (fetched, doc, entries)."""
    fetched = F.col("ingest_date") if "ingest_date" in docs.columns else F.lit(None).cast("date")
    return docs.select(fetched.alias("fetched"), F.col(ENTITY).alias("doc"), F.from_json("doc", S.TICKER_DIRECTORY).alias("entries"))
