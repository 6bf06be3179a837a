"""The stream's result does not depend on micro-batches; rejects are logged by content."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake import schemas as S
from curvelake.jobs import Warehouse
from curvelake.plans import documents as D
from curvelake.sinks import ledger as LG
from curvelake.sinks import writers as WR
from curvelake.streaming.bronze_stream import load_due, stream_bronze_to_silver

DAY = [dt.date(2026, 1, 26) + dt.timedelta(days=i) for i in range(4)]
DOCS = "entity_id string, ingest_date date, doc string"


def doc(**values):
    rows = ", ".join(f'{{"date": "2026-01-{d[1:]}", "value": "{v}"}}' for d, v in values.items())
    return f'{{"observations": [{rows}]}}'


def write(spark, bronze, *rows):
    return WR.write_bronze(spark.createDataFrame(rows, DOCS).coalesce(1), bronze, "fred")


def warehouse(spark, root):
    wh = Warehouse(root)
    jobs.write_config(spark.createDataFrame([(s, s, "x", True) for s in ("DGS10", "DGS2")], S.SERIES), wh.series)
    jobs.write_config(spark.createDataFrame([], S.COMPANIES), wh.companies)
    return wh


def silver(spark, wh):
    return sorted((r.series_id, r.observation_date.day, str(r.value)) for r in jobs.silver_observations(spark, wh).collect())


def rewritten(spark, bronze):
    """Writes replaced by later ones (with other dates), days that arrive in the wrong order."""
    write(spark, bronze, ("DGS10", DAY[2], doc(d05="9.5", d06="9.6")), ("DGS2", DAY[1], doc(d05="2.5")))
    write(spark, bronze, ("DGS10", DAY[0], doc(d05="4.0", d07="4.7")))
    write(spark, bronze, ("DGS10", DAY[0], doc(d05="5.0")))
    write(spark, bronze, ("DGS2", DAY[0], "<html>503</html>"), ("DGS2", DAY[1], doc(d05="2.6", d08="2.8")))
    D.land_files(spark.createDataFrame([("DGS10", DAY[1], doc(d05="8.0", d07="8.7")), ("DGS2", DAY[0], doc(d09="x"))], DOCS), bronze, "fred")


@pytest.mark.parametrize("max_files", [1, 2, 3, None])
def test_stream_equals_batch(spark, scratch, max_files):
    bronze = f"{scratch}/bronze"
    rewritten(spark, bronze)
    batch, stream = warehouse(spark, f"{scratch}/batch"), warehouse(spark, f"{scratch}/stream")
    jobs.backfill(spark, bronze, batch, DAY[0], DAY[3])
    stream_bronze_to_silver(spark, bronze, stream, f"{scratch}/ck", max_files=max_files).awaitTermination()
    assert silver(spark, stream) == silver(spark, batch) == [
        ("DGS10", 5, "5.0000"), ("DGS10", 6, "9.6000"), ("DGS10", 7, "8.7000"), ("DGS2", 5, "2.6000"), ("DGS2", 8, "2.8000")]
    keys = [{r.reject_key for r in spark.read.parquet(w.path("silver", "_rejects", "observations")).collect()} for w in (batch, stream)]
    assert keys[0] == keys[1] and len(keys[0]) == 2


def test_older_write_after_the_newer_one(spark, scratch):
    """A straggler whose replacement was loaded, and archived, before."""
    bronze, wh = f"{scratch}/bronze", warehouse(spark, f"{scratch}/wh")
    raw = lambda write_id, v: spark.createDataFrame([("fred", "DGS10", DAY[0], write_id, doc(d05=v))],
                                                    "source string, entity_id string, ingest_date date, write_id string, doc string")
    load_due(raw("w2", "5.0"), bronze, wh)
    load_due(raw("w1", "4.0"), bronze, wh)
    load_due(raw("w2", "5.0"), bronze, wh)      # replayed
    assert silver(spark, wh) == [("DGS10", 5, "5.0000")]
    assert spark.read.parquet(wh.path("silver", "_ledger", "observations")).count() == 1


def test_index_reads_no_bodies(spark, scratch):
    from curvelake.sources import bronze as B

    bronze = f"{scratch}/bronze"
    rewritten(spark, bronze)
    index = B.document_index(spark, bronze, "fred")
    assert sorted(index.columns) == sorted(LG.DOCUMENT) and index.count() == 8
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert all("doc" not in line and "content" not in line for line in plan.splitlines() if "ReadSchema" in line)


def test_rejects_by_content(spark, scratch):
    bronze, wh = f"{scratch}/bronze", warehouse(spark, f"{scratch}/wh")
    log = lambda: sorted((r.series_id or "", r.raw_value or "", r.reject_reason) for r in
                         spark.read.parquet(wh.path("silver", "_rejects", "observations")).collect())
    write(spark, bronze, ("DGS10", DAY[0], doc(d05="n/a", d06="1")), (None, DAY[0], doc(d05="1")), (None, DAY[0], "<html>"))
    for _ in range(2):
        jobs.run_daily(spark, bronze, wh, DAY[0])
    first = [("", "", "no observations"), ("", "1", "no series id"), ("DGS10", "n/a", "bad value")]
    assert log() == first
    write(spark, bronze, ("DGS10", DAY[0], doc(d05="oops", d06="1")), (None, DAY[0], "<html>other</html>"))
    jobs.run_daily(spark, bronze, wh, DAY[0])
    assert log() == sorted([*first, ("", "", "no observations"), ("DGS10", "oops", "bad value")])
    runs = jobs.runs(spark, wh).where("source = 'fred'").orderBy("run_id").collect()
    assert [(r.rejects, r.new_rejects, r.inserted) for r in runs] == [(3, 3, 1), (3, 0, 0), (2, 2, 0)]


def test_plus_in_a_landed_name(spark, scratch):
    from curvelake.sources import bronze as B

    D.land_files(spark.createDataFrame([("A+B%20C", DAY[0], "{}")], DOCS), f"{scratch}/b", "fred")
    assert [r.entity_id for r in B.raw_documents(spark, f"{scratch}/b", "fred").collect()] == ["A+B%20C"]


def test_why_a_document_has_no_payload(spark):
    from curvelake.operators import silver as SV
    from curvelake.sources import bronze as B

    bodies = {"<html>": B.NOT_JSON, "": B.NOT_JSON, None: B.NOT_JSON, "[1, 2]": B.NO_PAYLOAD, "{}": B.NO_PAYLOAD, "7": B.NO_PAYLOAD,
              '{"observations": null}': B.NO_PAYLOAD, '{"observations": 3}': B.OTHER_PAYLOAD, '{"observations": {"a": 1}}': B.OTHER_PAYLOAD,
              '{"observations": []}': None, '{"observations": [], "else": [1, {"x": null}]}': None}
    docs = spark.createDataFrame([("DGS10", DAY[0], b) for b in bodies], DOCS)
    typed = SV.typing_observations(B.observation_rows(B.parse_observation_docs(docs), keep_empty=True))
    got = sorted((str(r.doc_error) for r in typed.collect()))
    assert got == sorted(str(e) for e in bodies.values()) and typed.where("reject_reason <> 'no observations'").count() == 0
    messages = docs.select("doc", B.document_message("$.else[1].x", "none").alias("m")).collect()
    assert {r.m for r in messages} == {"none"}
