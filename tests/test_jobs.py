"""File round trips: bronze -> silver jobs, idempotence, backfill, streaming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake import jobs
from curvelake.jobs import Warehouse, backfill, run_daily, silver_filings, silver_observations, validate
from curvelake.operators import quality as Q
from curvelake.operators import merge as M
from curvelake.plans import catalog as C
from curvelake.plans import documents as D
from curvelake.sinks import writers as WR
from curvelake.sources import bronze as B
from curvelake.sources import tables as T
from curvelake.streaming.bronze_stream import stream_bronze_to_silver
from tests.conftest import SF_SMALL

DAY1, DAY2 = dt.date(2026, 1, 27), dt.date(2026, 1, 28)


def key_set(df):
    return {tuple(r) for r in df.select("observation_date", "series_id", "value").collect()}


@pytest.fixture()
def landed(spark, scratch):
    """Two ingest days of bronze (day 2 carries revisions) and the config tables."""
    bronze = f"{scratch}/bronze"
    o = T.observations(spark, SF_SMALL)
    early = o.where(F.col("observation_date") < F.lit(C.CUTOFF))
    WR.write_bronze(D.render_observation_docs(C._raw_observation_strings(early, revise=False), F.lit(DAY1)),
                    bronze, "fred")
    WR.write_bronze(D.render_observation_docs(C._raw_observation_strings(o, revise=True), F.lit(DAY2)),
                    bronze, "fred")
    fil = T.filings(spark, SF_SMALL)
    WR.write_bronze(D.render_filing_docs(fil, F.lit(DAY1)), bronze, "sec")
    return bronze


def warehouse(spark, root):
    wh = Warehouse(root)
    jobs.write_config(T.series(spark), wh.series)
    jobs.write_config(T.companies(spark, SF_SMALL), wh.companies)
    return wh


def test_daily_is_idempotent_and_backfill_equals_daily(spark, scratch, landed):
    wh = warehouse(spark, f"{scratch}/wh1")
    r1 = {r.source: r for r in run_daily(spark, landed, wh, DAY1).collect()}
    assert r1["fred"].silver_rows > 0 and r1["sec"].silver_rows > 0
    again = {r.source: r.silver_rows for r in run_daily(spark, landed, wh, DAY1).collect()}
    assert again == {"fred": 0, "sec": 0}
    run_daily(spark, landed, wh, DAY2)
    daily = key_set(silver_observations(spark, wh))

    wh2 = warehouse(spark, f"{scratch}/wh2")
    backfill(spark, landed, wh2, DAY1, DAY2)
    assert key_set(silver_observations(spark, wh2)) == daily
    # first wins: values before the cutoff are day 1's, not day 2's revisions
    o = T.observations(spark, SF_SMALL)
    expect = key_set(o.where((F.dayofmonth("observation_date") != 15)
                             & ~((F.month("observation_date") == 2) & (F.dayofmonth("observation_date") == 29))
                             & (F.col("series_id") != "TEDRATE")))
    assert daily == expect
    # silver has unique keys; the gate passes and results are stored
    validate(spark, wh, "run-1")
    assert spark.read.parquet(wh.path("quality", "results")).count() == len(Q.observation_suite())
    # filings of inactive companies are not loaded
    active = T.companies(spark, SF_SMALL).where("is_active").select("cik")
    loaded = silver_filings(spark, wh).select(F.ltrim("cik", F.lit("0")).alias("cik")).distinct()
    assert loaded.join(active, "cik", "left_anti").count() == 0


def test_gate_blocks_duplicates(spark):
    o = spark.createDataFrame([(dt.date(2026, 1, 1), "DGS10", None), (dt.date(2026, 1, 1), "DGS10", None)],
                              S.OBSERVATIONS)
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_suite(o, Q.observation_suite()))


def test_stream_equals_batch_and_replays_nothing(spark, scratch, landed):
    wh_b = warehouse(spark, f"{scratch}/batch")
    backfill(spark, landed, wh_b, DAY1, DAY2)
    wh_s = warehouse(spark, f"{scratch}/stream")
    ck = f"{scratch}/ckpt"
    stream_bronze_to_silver(spark, landed, wh_s, ck).awaitTermination()
    n = silver_observations(spark, wh_s).count()
    assert key_set(silver_observations(spark, wh_s)) == key_set(silver_observations(spark, wh_b))
    stream_bronze_to_silver(spark, landed, wh_s, ck).awaitTermination()  # nothing new arrived
    assert silver_observations(spark, wh_s).count() == n


def test_bronze_rewrite_replaces_only_that_entity_and_day(spark, scratch, landed):
    before = B.read_observation_docs(spark, landed).groupBy("series_id", "ingest_date").count().collect()
    one = spark.createDataFrame([("DGS10", DAY2, '{"observations": []}')], DOCS)
    WR.write_bronze(one, landed, "fred")
    after = {(r.series_id, r.ingest_date): r["count"] for r in
             B.read_observation_docs(spark, landed).groupBy("series_id", "ingest_date").count().collect()}
    assert after == {(r.series_id, r.ingest_date): r["count"] for r in before} | {("DGS10", DAY2): 1}
    pruned = B.read_observation_docs(spark, landed, (DAY1, DAY1))
    assert [r.ingest_date for r in pruned.select("ingest_date").distinct().collect()] == [DAY1]


DOCS = "entity_id string, ingest_date date, doc string"


def test_bronze_keeps_any_body(spark, scratch):
    """Several lines, no JSON, an array, no entity: written and read back as they came."""
    bodies = [("A", '{\n  "observations": [\n {"date": "2026-01-26", "value": "1.5"}\n ]\n}'), ("B", "<html>\n429\n</html>"),
              ("C", "[1, 2]"), ("D", ""), ("E", None), (None, '{"observations": [{"date": "2026-01-26", "value": "2"}]}'), ("F", "é\"\\ \r\n")]
    WR.write_bronze(spark.createDataFrame([(e, DAY1, d) for e, d in bodies], DOCS), f"{scratch}/raw", "fred")
    raw = B.raw_documents(spark, f"{scratch}/raw", "fred").collect()
    assert sorted(((r.entity_id, r.doc) for r in raw), key=str) == sorted(bodies, key=str)
    assert {(r.source, r.ingest_date) for r in raw} == {("fred", DAY1)}
    rows = B.observation_rows(B.read_observation_docs(spark, f"{scratch}/raw")).collect()
    assert sorted(((r.series_id, r.value) for r in rows), key=str) == sorted([("A", "1.5"), (None, "2")], key=str)
    wh = warehouse(spark, f"{scratch}/wh-any")
    jobs.write_config(spark.createDataFrame([(e, e, "x", True) for e in "ABCDEF"], S.SERIES), wh.series)
    got = {r.source: (r.entities, r.entities_seen, r.silver_rows) for r in run_daily(spark, f"{scratch}/raw", wh, DAY1).collect()}
    assert got["fred"] == (6, 6, 1)
    rejects = spark.read.parquet(wh.path("silver", "_rejects", "observations")).collect()
    assert sorted(((r.series_id, r.reject_reason) for r in rejects), key=str) == sorted(
        [(e, "no observations") for e in "BCDEF"] + [(None, "no series id")], key=str)


def land(root, source, day, entity, text, age_days=0):
    import os
    import time

    folder = f"{root}/{source}/{day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{entity}.json", "w") as f:
        f.write(text)
    then = time.time() - age_days * 86400
    os.utime(f"{folder}/{entity}.json", (then, then))


def one(value, date="2026-01-26"):
    return '{"observations": [\n{"date": "%s", "value": "%s"}]}' % (date, value)


def test_both_layouts_are_read_together(spark, scratch):
    root = f"{scratch}/both".removeprefix("file:")
    land(root, "fred", DAY1, "DGS2", one("2"))
    WR.write_bronze(spark.createDataFrame([("DGS10", DAY1, one("10"))], DOCS), root, "fred")
    docs = B.read_observation_docs(spark, root, (DAY1, DAY1))
    assert sorted((r.series_id, r.ingest_date, r.value) for r in B.observation_rows(docs.withColumn("ingest_date", F.col("ingest_date"))).collect()) == \
        [("DGS10", DAY1, "10"), ("DGS2", DAY1, "2")]
    wh = warehouse(spark, f"{scratch}/wh-both")
    stream_bronze_to_silver(spark, root, wh, f"{scratch}/ck-both").awaitTermination()
    assert key_set(silver_observations(spark, wh)) == key_set(spark.sql(
        "SELECT DATE '2026-01-26' AS observation_date, 'DGS10' AS series_id, CAST(10 AS DECIMAL(10,4)) AS value "
        "UNION ALL SELECT DATE '2026-01-26', 'DGS2', 2"))


def test_stream_loads_old_files_too(spark, scratch):
    root = f"{scratch}/old".removeprefix("file:")
    wh, ck = warehouse(spark, f"{scratch}/wh-old"), f"{scratch}/ck-old"
    land(root, "fred", DAY2, "DGS2", one("2"))
    stream_bronze_to_silver(spark, root, wh, ck).awaitTermination()
    land(root, "fred", DAY1, "DGS10", one("10"), age_days=400)
    stream_bronze_to_silver(spark, root, wh, ck).awaitTermination()
    assert {r.series_id for r in silver_observations(spark, wh).collect()} == {"DGS2", "DGS10"}


def test_daily_then_stream_then_daily_keeps_each_key_once(spark, scratch):
    bronze, wh = f"{scratch}/dsd", warehouse(spark, f"{scratch}/wh-dsd")
    WR.write_bronze(spark.createDataFrame([("DGS10", DAY1, one("1", "2026-01-26"))], DOCS), bronze, "fred")
    run_daily(spark, bronze, wh, DAY1)
    WR.write_bronze(spark.createDataFrame([("DGS10", DAY2, one("2", "2026-01-27"))], DOCS), bronze, "fred")
    stream_bronze_to_silver(spark, bronze, wh, f"{scratch}/ck-dsd").awaitTermination()
    run_daily(spark, bronze, wh, DAY2)
    rows = [(str(r.observation_date), float(r.value)) for r in silver_observations(spark, wh).collect()]
    assert sorted(rows) == [("2026-01-26", 1.0), ("2026-01-27", 2.0)]
    validate(spark, wh, "dsd")


def test_missing_config_fails(spark, scratch, landed):
    with pytest.raises(WR.MissingConfig):
        run_daily(spark, landed, Warehouse(f"{scratch}/no-config"), DAY1)


def test_load_leaves_nothing_staged(spark, scratch, landed):
    import os

    from curvelake.session import shared_dir

    shared = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    run_daily(spark, landed, warehouse(spark, f"{scratch}/wh-staged"), DAY1)
    assert not {n for n in set(os.listdir(shared)) - before if n.startswith("load-")}


def test_failed_filing_documents_are_reported(spark, scratch):
    bronze, wh = f"{scratch}/fil-err", warehouse(spark, f"{scratch}/wh-fil-err")
    cik = T.companies(spark, SF_SMALL).where("is_active and cik <> '0'").first().cik
    WR.write_bronze(spark.createDataFrame([(cik, DAY1, "429 Too Many Requests")], DOCS), bronze, "sec")
    got = {r.source: (r.entities_seen, r.silver_rows) for r in run_daily(spark, bronze, wh, DAY1).collect()}
    assert got["sec"] == (1, 0)
    rejects = spark.read.parquet(wh.path("silver", "_rejects", "filings")).collect()
    assert [(r.cik, r.reject_reason) for r in rejects] == [(cik, "no filings")]


def test_filings_constraints(spark, scratch):
    doc = '{"cik": "1", "name": "N", "filings": {"recent": {"accessionNumber": [null, "", "%s", "ok"], "form": ["a", "b", "c", "%s"], ' \
          '"filingDate": ["2026-01-01", "2026-01-01", "2026-01-01", "2026-01-01"]}}}' % ("x" * 26, "8-K")
    docs = B.parse_filing_docs(spark.createDataFrame([("1", DAY1, doc)], DOCS))
    from curvelake.operators import silver as SV

    empty = spark.createDataFrame([], S.FILINGS)
    load = SV.load_filings(docs, empty)
    assert [r.accession_number for r in load.new_rows.collect()] == ["ok"]
    assert sorted(r.reject_reason for r in load.rejects.collect()) == ["no accession number", "no accession number", "value too long"]


def test_two_documents_of_a_day_never_tie(spark):
    from curvelake.operators import silver as SV

    a, b = [("DGS10", DAY1, one(v)) for v in ("1", "2")]
    empty = spark.createDataFrame([], S.OBSERVATIONS)
    got = {float(SV.load_observations(B.parse_observation_docs(spark.createDataFrame(rows, DOCS).repartition(n)), empty)
                 .new_rows.first().value) for rows in ([a, b], [b, a]) for n in (1, 2, 3)}
    assert len(got) == 1


def test_create_tables_at_the_documented_size(spark, scratch):
    from curvelake.session import scale_conf, setting

    conf = scale_conf(100 * 1024 ** 4, 1000, 8)
    with setting(spark, "spark.curvelake.buckets", conf["spark.curvelake.buckets"]), \
            setting(spark, "spark.sql.shuffle.partitions", conf["spark.sql.shuffle.partitions"]):
        obs, _ = jobs.create_tables(spark, Warehouse(f"{scratch}/wh-big"))
        assert spark.table(obs).schema["series_id"].dataType.simpleString() == "string"


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from curvelake import session

    class Cluster:
        class sparkContext:
            applicationId, master = "x", "spark://host:7077"
        class conf:
            get = staticmethod(lambda key, default: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


def test_config_commands(spark, scratch):
    from curvelake.__main__ import main

    wh = Warehouse(f"{scratch}/wh-config")
    call = lambda *a: main(["config", "--warehouse", wh.root, *a])
    call("seed")
    made = {r.series_id: r.created_at for r in jobs.series_config(spark, wh).collect()}
    assert len(made) == len(S.SERIES_SEED) and all(made.values())
    call("deactivate", "--table", "series", "--ids", "DGS10,DGS2")
    call("seed")
    rows = {r.series_id: r for r in jobs.series_config(spark, wh).collect()}
    assert {k for k, r in rows.items() if not r.is_active} == {"DGS10", "DGS2"}
    assert {k: r.created_at for k, r in rows.items()} == made
    for day, ticker in (("2026-01-02", "NEW"), ("2026-01-01", "OLD")):
        land(f"{scratch}/dir".removeprefix("file:"), "tickers", day, "all", '{"0": {"cik_str": 1, "ticker": "%s", "title": "Acme"}}' % ticker)
    call("companies", "--directory", f"{scratch}/dir/tickers/*/*.json")
    call("add", "--table", "companies", "--row", '2,BB,"Bee, Inc."')
    got = {r.cik: (r.ticker, r.name, r.is_active) for r in jobs.companies_config(spark, wh).collect()}
    assert got == {"1": ("NEW", "Acme", True), "2": ("BB", "Bee, Inc.", True)}
    with pytest.raises(Exception, match="duplicate key"):
        call("add", "--table", "companies", "--row", "2,CC,again")
    call("list", "--table", "companies")
    main(["sql", "--warehouse", wh.root, "SELECT * FROM reference.fred_series"])


def test_compaction_keeps_rows_and_leaves_one_file_per_bucket(spark, scratch, landed):
    import glob

    wh = warehouse(spark, f"{scratch}/wh-compact")
    run_daily(spark, landed, wh, DAY1)
    run_daily(spark, landed, wh, DAY2)
    from curvelake.sinks.catalog import generations

    before = key_set(silver_observations(spark, wh))
    files = lambda: glob.glob(generations(spark, wh.observations)[-1].removeprefix("file:") + "/part-*.parquet")
    many = len(files())
    jobs.compact(spark, wh)
    assert key_set(silver_observations(spark, wh)) == before
    assert len(files()) < many and len(files()) <= 8


def test_versioned_upsert_never_overwrites_what_it_reads(spark, scratch):
    root = f"{scratch}/companies"
    WR.write_versioned(T.companies(spark, SF_SMALL), root)
    cur = WR.read_versioned(spark, root, S.COMPANIES)
    rows = spark.createDataFrame([("1", "NEW1", "Renamed")], "cik string, ticker string, name string")
    v2 = WR.write_versioned(M.upsert(cur, rows, ["cik"], ["ticker", "name"]), root)
    assert WR.current_version(spark, root) == v2
    r = WR.read_versioned(spark, root, S.COMPANIES).where("cik = '1'").collect()[0]
    assert (r.ticker, r.name) == ("NEW1", "Renamed")


def test_company_directory_file(spark, scratch):
    path = f"{scratch}/tickers"
    spark.createDataFrame([('{"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."}, '
                            '"1": {"cik_str": 789019, "ticker": "MSFT", "title": "Microsoft Corp"}}',)],
                          "value string").coalesce(1).write.text(path)
    rows = B.ticker_rows(B.read_company_directory(spark, path)).collect()
    assert sorted((r.cik, r.ticker) for r in rows) == [("320193", "AAPL"), ("789019", "MSFT")]


def test_error_documents_are_reported_as_rejects(spark, scratch):
    bronze, wh = f"{scratch}/bronze-err", warehouse(spark, f"{scratch}/wh-err")
    docs = spark.createDataFrame([
        ("DGS10", DAY1, '{"observations": [{"date": "2026-01-26", "value": "4.23"}]}'),
        ("DGS2", DAY1, '{"error_code": 400, "error_message": "Bad Request"}'),
    ], "entity_id string, ingest_date date, doc string")
    WR.write_bronze(docs, bronze, "fred")
    res = {r.source: (r.entities_seen, r.silver_rows) for r in run_daily(spark, bronze, wh, DAY1).collect()}
    assert res["fred"] == (2, 1)
    rej = spark.read.parquet(wh.path("silver", "_rejects", "observations")).collect()
    assert [(r.series_id, r.reject_reason) for r in rej] == [("DGS2", "no observations")]
    run_daily(spark, bronze, wh, DAY1)   # a re-run logs nothing twice
    assert spark.read.parquet(wh.path("silver", "_rejects", "observations")).count() == 1


def test_reads_one_file_per_entity_layout(spark, scratch):
    """Documents landed as <root>/fred/<day>/<series>.json: id from the file name."""
    import os

    root = f"{scratch}/landed"
    for day, sid, val in [("2026-01-27", "DGS10", "4.25"), ("2026-01-27", "DGS2", "3.60"),
                          ("2026-01-28", "DGS10", "4.26")]:
        os.makedirs(f"{root}/fred/{day}", exist_ok=True)
        with open(f"{root}/fred/{day}/{sid}.json", "w") as fh:
            fh.write('{"observations": [{"date": "%s", "value": "%s"}]}' % (day, val))
    docs = B.read_observation_docs(spark, root, (DAY1, DAY1))
    rows = sorted((r.series_id, r.ingest_date, r.value) for r in B.observation_rows(docs).collect())
    assert rows == [("DGS10", DAY1, "4.25"), ("DGS2", DAY1, "3.60")]
    assert B.read_observation_docs(spark, root).count() == 3


def test_command_line_daily_validate_gold(spark, scratch, landed):
    from curvelake.__main__ import main

    wh = warehouse(spark, f"{scratch}/wh-cli")
    main(["daily", "--bronze", landed, "--warehouse", wh.root, "--date", str(DAY1)])
    main(["validate", "--warehouse", wh.root, "--run-id", "cli"])
    main(["gold", "--warehouse", wh.root, "--out", f"{scratch}/gold"])
    snap = spark.read.parquet(f"{scratch}/gold/daily_snapshot")
    assert snap.count() > 0 and "stress_level" in snap.columns


def test_gate_before_append_blocks_a_bad_batch(spark, scratch):
    bronze, wh = f"{scratch}/bronze-gate", warehouse(spark, f"{scratch}/wh-gate")
    docs = spark.createDataFrame([
        ("DGS10", DAY1, '{"observations": [{"date": "2026-01-26", "value": "4.23"}]}'),
        ("dgs10", DAY1, '{"observations": [{"date": "2026-01-26", "value": "4.24"}]}'),
    ], "entity_id string, ingest_date date, doc string")
    WR.write_bronze(docs, bronze, "fred")
    jobs.write_config(spark.createDataFrame([("dgs10", "lower-case id", "treasury", True)], S.SERIES)
                      .unionByName(T.series(spark)), wh.series)
    with pytest.raises(Q.QualityGateError):
        run_daily(spark, bronze, wh, DAY1, gate_before_append=True)
    assert silver_observations(spark, wh).count() == 0          # nothing was appended
    run_daily(spark, bronze, wh, DAY1)                          # default: load, validate after
    assert silver_observations(spark, wh).count() == 2
    with pytest.raises(Q.QualityGateError):
        validate(spark, wh, "after")


def test_stream_in_small_batches_equals_batch(spark, scratch, landed):
    from curvelake.__main__ import main

    wh_b = warehouse(spark, f"{scratch}/batch-mf")
    backfill(spark, landed, wh_b, DAY1, DAY2)
    wh_s = warehouse(spark, f"{scratch}/stream-mf")
    main(["stream", "--bronze", landed, "--warehouse", wh_s.root, "--checkpoint", f"{scratch}/ckpt-mf",
          "--max-files", "1"])
    assert key_set(silver_observations(spark, wh_s)) == key_set(silver_observations(spark, wh_b))
