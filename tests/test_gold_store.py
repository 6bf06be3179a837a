"""Gold refreshed from what silver gained equals gold over all of silver."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows
from curvelake.jobs import Warehouse
from curvelake.operators import gold
from curvelake.sinks import catalog
from curvelake.sinks import gold_store as GS

D = dt.date(2026, 1, 1)
NAMES = ("yield_curve", "full_yield_curve", "credit_stress", "daily_snapshot", "company_filings_summary")


def load(spark, wh, obs=(), fil=()):
    o, f = jobs.create_tables(spark, wh, buckets=2)
    now = F.current_timestamp()
    if obs:
        catalog.append_bucketed(literal_rows(spark, list(obs), S.OBSERVATIONS).withColumn("ingested_at", now), o, "series_id", 2, ["series_id", "observation_date"])
    if fil:
        catalog.append_bucketed(literal_rows(spark, list(fil), S.FILINGS).withColumn("ingested_at", now), f, "accession_number", 2, ["accession_number"])


def day(n):
    return D + dt.timedelta(days=n)


def obs(series, days, value):
    from decimal import Decimal

    return [(day(n), series, Decimal(value)) for n in days]


@pytest.fixture()
def wh(spark, scratch):
    w = Warehouse(f"{scratch}/wh")
    jobs.write_config(spark.createDataFrame([("1", "A", "Acme", True), ("2", "B", "Bee", True)], S.COMPANIES), w.companies)
    return w


def full(spark, wh):
    o, f = jobs.silver_observations(spark, wh), jobs.silver_filings(spark, wh)
    return [gold.yield_curve(o), gold.full_yield_curve(o), gold.credit_stress(o), gold.daily_snapshot(o),
            gold.filings_summary(f, jobs.companies_config(spark, wh))]


def same(spark, wh):
    for name, want in zip(NAMES, full(spark, wh), strict=True):
        got = GS.dataset(spark, wh, name)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


LOADS = [
    dict(obs=obs("DGS10", range(5), "4.1"), fil=[("a1", "0000000001", "x", "10-K", day(3))]),
    dict(obs=obs("DGS2", range(2, 8), "3.9") + obs("VIXCLS", [1, 20], "18"), fil=[("a2", "0000000001", "x", "8-K", day(1)), ("a3", "0000000002", "x", "10-Q", None)]),
    dict(obs=obs("SOFR", [30], "5")),                                   # a date without any gold column
    dict(obs=obs("BAMLH0A0HYM2", [0, 3], "7.5"), fil=[("a4", "0000000009", "x", "10-K", day(2))]),
]


@pytest.mark.parametrize("fold", [16, 1])
def test_refresh_equals_full(spark, wh, monkeypatch, fold):
    monkeypatch.setattr(GS, "FOLD_PARTS", fold)
    GS.refresh(spark, wh)                                               # nothing there yet
    same(spark, wh)
    for n, part in enumerate(LOADS):
        load(spark, wh, **part)
        GS.refresh(spark, wh)
        GS.refresh(spark, wh)                                           # nothing new: no part
        same(spark, wh)
        assert len(GS.parts(spark, wh, "curve")) <= (n + 1 if fold == 16 else 2)
    jobs.compact(spark, wh)
    GS.refresh(spark, wh)
    same(spark, wh)


def test_only_gained_rows_are_read(spark, wh):
    load(spark, wh, obs=[r for s in ("DGS10", "DGS2", "DGS30") for r in obs(s, range(2000), "4")])
    GS.refresh(spark, wh)
    load(spark, wh, obs=obs("DGS5", [3, 4], "4"))
    rows, upto = GS.gained(spark, wh, "curve")
    out = GS._curve_part(rows)
    assert sorted(r.observation_date for r in out.collect()) == [day(3), day(4)]
    plan = out._jdf.queryExecution().executedPlan()
    assert "GreaterThan(ingested_at" in plan.toString()

    def scanned(node):
        metrics = node.metrics()
        own = metrics.apply("numOutputRows").value() if "Scan parquet" in node.nodeName() else 0
        inner = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if node.nodeName().endswith("QueryStage") else None
        children = node.children()
        return own + (scanned(inner) if inner is not None else 0) + sum(scanned(children.apply(i)) for i in range(children.size()))

    assert scanned(plan) == 2        # of 6,002: row groups of the first load are skipped
    GS.refresh(spark, wh)
    same(spark, wh)


def test_refresh_that_fails_is_done_again(spark, wh, monkeypatch):
    load(spark, wh, **LOADS[0])
    with monkeypatch.context() as m:
        real = CT_FS = catalog._fs
        m.setattr(catalog, "_fs", lambda s, p: (_ for _ in ()).throw(OSError("lost")) if "~" in p else real(s, p))
        with pytest.raises(OSError):
            GS.refresh(spark, wh)
    assert CT_FS is catalog._fs and GS.parts(spark, wh, "curve") == []
    GS.refresh(spark, wh)
    same(spark, wh)
