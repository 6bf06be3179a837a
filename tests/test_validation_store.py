"""Validation of the touched buckets equals the full suite."""

import datetime as dt

import pytest

from curvelake import jobs
from curvelake import schemas as S
from curvelake.operators import constraints as C
from curvelake.operators import quality as Q
from curvelake.sinks import validation_store as VS
from tests.test_gold_store import load, obs

D = dt.date(2026, 1, 1)


def same(spark, wh):
    full = {"observations": Q.run_suite(jobs.silver_observations(spark, wh).drop("ingested_at"), Q.observation_suite()),
            "filings": Q.run_suite(jobs.silver_filings(spark, wh).drop("ingested_at"), C.suite("filings"))}
    for table, want in full.items():
        got = VS.results(spark, wh, table)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_refresh_equals_full_suite(spark, scratch):
    wh = jobs.Warehouse(f"{scratch}/wh-v")
    jobs.create_tables(spark, wh, buckets=4)
    assert VS.refresh(spark, wh) == 0
    same(spark, wh)
    fil = lambda a, cik, n: (a, cik, n, "10-K", D)
    loads = [dict(obs=[r for s in ("DGS1", "DGS2", "DGS5", "DGS10", "DGS20", "DGS30", "SOFR") for r in obs(s, range(50), "1")],
                  fil=[fil(f"a{i}", "1", "n") for i in range(20)]),
             dict(obs=obs("DGS10", [60], "1") + obs("bad id", [1, 2], "1")),
             dict(obs=obs("DGS10", [60, 3], "2"), fil=[fil("a3", "1" * 11, "n"), fil("b", "2", "n" * 300)]),     # keys that an older load has
             dict(obs=obs("X" * 25, [1], "1"))]
    for n, part in enumerate(loads):
        load(spark, wh, **part)
        touched = VS.refresh(spark, wh)
        VS.refresh(spark, wh, "filings")
        assert (touched >= 2) if n == 0 else (1 <= touched <= 2)
        same(spark, wh)
    assert VS.refresh(spark, wh) == 0
    with pytest.raises(Q.QualityGateError, match="unique"):
        VS.validate_new(spark, wh)
    jobs.compact(spark, wh)
    load(spark, wh, obs=obs("SOFR", [99], "1"))
    assert VS.refresh(spark, wh) == 1
    same(spark, wh)


def test_only_touched_buckets_are_read(spark, scratch):
    wh = jobs.Warehouse(f"{scratch}/wh-t")
    jobs.create_tables(spark, wh, buckets=8)
    load(spark, wh, obs=[r for i in range(40) for r in obs(f"S{i}", range(5), "1")])
    VS.refresh(spark, wh)
    load(spark, wh, obs=obs("S7", [9], "1"))
    rows = jobs.silver_observations(spark, wh)
    b = rows.where("series_id = 'S7'").select(VS.CT.bucket_of("series_id", 8).alias("b")).first().b
    files = VS.CT.touched_files(rows, {b})
    assert len(rows.inputFiles()) >= 8 and len(files) == 2     # of the first load and of the second
    held = {r.series_id for r in spark.read.parquet(*files).select("series_id").distinct().collect()}
    assert "S7" in held and held == {r.series_id for r in rows.where(VS.CT.bucket_of("series_id", 8) == b).select("series_id").distinct().collect()}


def test_a_run_that_fails_is_done_again(spark, scratch, monkeypatch):
    wh = jobs.Warehouse(f"{scratch}/wh-x")
    jobs.create_tables(spark, wh, buckets=2)
    load(spark, wh, obs=obs("DGS10", range(4), "1"))
    real = VS.CT._fs
    with monkeypatch.context() as m:
        m.setattr(VS.CT, "_fs", lambda s, p: (_ for _ in ()).throw(OSError("lost")) if "~" in p else real(s, p))
        with pytest.raises(OSError):
            VS.refresh(spark, wh)
    assert VS.parts(spark, wh, "observations") == [] and VS.refresh(spark, wh) == 1
    same(spark, wh)
    assert S.OBSERVATIONS_KEY == ["observation_date", "series_id"]
