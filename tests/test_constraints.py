"""Declared constraints at every keyed write; compaction that fails loses nothing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows
from curvelake.jobs import Warehouse
from curvelake.operators import constraints as C
from curvelake.operators import silver as SV
from curvelake.sinks import catalog
from curvelake.sinks.writers import current_version

D = dt.date(2026, 1, 26)


def test_declared_from_the_schemas():
    assert [c.name for c in C.declared("observations")] == [
        "NOT NULL (observation_date)", "NOT NULL (series_id)", "VARCHAR(20) (series_id)", "PRIMARY KEY (observation_date, series_id)"]
    assert {t for t in S.TABLES} == set(S.MAX_LENGTHS)


GOOD = {
    "observations": (D, "DGS10", None), "filings": ("a" * 25, "1" * 10, None, None, None),
    "series": ("s" * 20, "n" * 100, "c" * 50, None), "companies": ("1" * 10, "t" * 10, "n" * 255, None),
}


@pytest.mark.parametrize("table", list(S.TABLES))
def test_one_violation_of_each_kind(spark, table):
    schema = S.TABLES[table][0]
    loose = S.T.StructType([S.T.StructField(f.name, f.dataType, True) for f in schema.fields])
    names, good = schema.fieldNames(), GOOD[table]
    bad = []
    for c in C.declared(table):
        if c.kind != "PRIMARY KEY":
            i = names.index(c.columns[0])
            row = list(good)
            row[i] = None if c.kind == "NOT NULL" else "x" * (c.limit + 1)
            bad.append((c, tuple(row)))
    df = literal_rows(spark, [good, good, *[r for _, r in bad]], loose)
    got = {r.constraint: (r.rows, r.violations) for r in C.check(df, table).collect()}
    assert set(got) == {c.name for c in C.declared(table)} and all(n == len(bad) + 2 for n, _ in got.values())
    assert all(v == (1 if "KEY" not in name else 2 + sum(set(c.columns).isdisjoint(S.TABLES[table][1]) for c, _ in bad))
               for name, (_, v) in got.items())
    assert [r.b for r in df.select(C.broken_row(table).alias("b")).collect()] == [None, None, *[c.name for c, _ in bad]]
    C.enforce(df.limit(1), table)
    assert C.guarded(df.limit(2), table).count() == 2
    for c, row in bad:
        one = literal_rows(spark, [row], loose)
        with pytest.raises(C.ConstraintError, match=c.kind if c.kind == "NOT NULL" else "VARCHAR"):
            C.enforce(one, table)
        with pytest.raises(Exception, match="violated by"):
            C.guarded(one, table).collect()


def seeded(spark, root):
    wh = Warehouse(root)
    jobs.change_config(spark, wh, "seed")
    return wh


def test_config_changes_that_break_a_constraint_leave_the_table(spark, scratch):
    wh = seeded(spark, f"{scratch}/wh")
    version = current_version(spark, wh.series)
    for row in (["S" * 40, "name", "x"], ["OK", "n" * 200, "x"], ["OK", None, "x"], ["DGS10", "again", "x"]):
        with pytest.raises(Exception, match="violated by|duplicate key"):
            jobs.change_config(spark, wh, "add", "series", row=row)
    doubled = jobs.series_config(spark, wh).unionByName(jobs.series_config(spark, wh))
    with pytest.raises(C.ConstraintError, match="PRIMARY KEY"):
        jobs.write_config(doubled, wh.series)
    assert current_version(spark, wh.series) == version and jobs.series_config(spark, wh).count() == len(S.SERIES_SEED)


def test_updates_that_break_a_constraint_raise(spark):
    series = spark.createDataFrame([("A", "a", "x", True)], S.SERIES)
    for update in (("A", "n" * 101, "x"), ("B" * 21, "b", "x"), ("A", None, "x")):
        u = spark.createDataFrame([update], "series_id string, name string, category string")
        with pytest.raises(Exception, match="series: .* violated by"):
            SV.upsert_series(series, u).collect()
    companies = spark.createDataFrame([("1", "A", "a", True)], S.COMPANIES)
    entry = spark.createDataFrame([("1", None, "x", D, "f", 0)], "cik string, ticker string, name string, fetched date, doc string, pos long")
    with pytest.raises(Exception, match="NOT NULL .ticker."):
        SV.upsert_companies(companies, entry).collect()


def test_filings_suite_is_stored_and_gates(spark, scratch):
    wh = Warehouse(f"{scratch}/wh-f")
    _, fil = jobs.create_tables(spark, wh, buckets=2)
    row = lambda a, cik: (a, cik, "n", "10-K", D)
    catalog.append_bucketed(literal_rows(spark, [row("1", "1"), row("2", "1")], S.FILINGS).withColumn("ingested_at", F.current_timestamp()),
                            fil, "accession_number", 2, ["accession_number"])
    assert jobs.validate(spark, wh, "r1", "filings").where("NOT success").count() == 0
    catalog.append_bucketed(literal_rows(spark, [row("2", "1" * 11)], S.FILINGS).withColumn("ingested_at", F.current_timestamp()),
                            fil, "accession_number", 2, ["accession_number"])
    with pytest.raises(Exception, match="2 expectation"):
        jobs.validate(spark, wh, "r2", "filings")
    stored = spark.read.parquet(wh.path("quality", "results")).where("suite = 'sec_data_suite'")
    assert stored.groupBy("run_id").count().count() == 2


# --- compaction ------------------------------------------------------------------


def filled(spark, root):
    wh = Warehouse(root)
    for load in range(3):
        obs, _ = jobs.create_tables(spark, wh, buckets=2)
        rows = [(D + dt.timedelta(days=load), f"S{i}", None) for i in range(20)]
        catalog.append_bucketed(spark.createDataFrame(rows, S.OBSERVATIONS).withColumn("ingested_at", F.current_timestamp()),
                                obs, "series_id", 2, ["series_id", "observation_date"])
    return wh


def rows(spark, wh):
    return sorted((r.series_id, r.observation_date) for r in jobs.silver_observations(spark, wh).collect())


@pytest.mark.parametrize("step", ["append_bucketed", "name_generation"])
def test_compaction_that_fails_loses_nothing(spark, scratch, monkeypatch, step):
    wh = filled(spark, f"{scratch}/wh-{step}")
    before = rows(spark, wh)
    real = getattr(catalog, step)

    def fail(*a, **k):
        if step == "append_bucketed":
            real(*a, **k)           # the files are there, the run ends before they count
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(catalog, step, fail)
        with pytest.raises(OSError):
            jobs.compact(spark, wh)
    assert rows(spark, wh) == before
    obs, _ = jobs.create_tables(spark, wh)
    more = spark.createDataFrame([(D, "NEW", None)], S.OBSERVATIONS).withColumn("ingested_at", F.current_timestamp())
    catalog.append_bucketed(more, obs, "series_id", 2, ["series_id", "observation_date"])
    jobs.compact(spark, wh)
    assert rows(spark, wh) == sorted([*before, ("NEW", D)])
    folders = [n for n in os.listdir(wh.path("silver").removeprefix("file:")) if n.startswith("treasury_yields")]
    assert len(folders) == 2     # the table as it was before and the new generation; what failed is gone


def test_loads_go_on_after_compaction(spark, scratch):
    wh = filled(spark, f"{scratch}/wh-on")
    before = rows(spark, wh)
    spark.sql("CREATE OR REPLACE TEMP VIEW held AS SELECT * FROM " + jobs.create_tables(spark, wh)[0])
    for n in range(2):
        jobs.compact(spark, wh)
        obs, _ = jobs.create_tables(spark, wh)
        more = spark.createDataFrame([(D, f"N{n}", None)], S.OBSERVATIONS).withColumn("ingested_at", F.current_timestamp())
        catalog.append_bucketed(more, obs, "series_id", 2, ["series_id", "observation_date"])
    assert rows(spark, wh) == sorted([*before, ("N0", D), ("N1", D)])
    assert spark.table("held").count() == len(before) + 2
    plan = jobs.silver_observations(spark, wh).groupBy("series_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan     # still bucketed


# --- loads read the buckets they touch --------------------------------------------


def test_load_reads_only_touched_buckets(spark, scratch):
    wh = Warehouse(f"{scratch}/wh-near")
    table, _ = jobs.create_tables(spark, wh, buckets=8)
    day = lambda n: D + dt.timedelta(days=n)
    catalog.append_bucketed(spark.createDataFrame([(day(n), f"S{i}", None) for i in range(60) for n in range(3)], S.OBSERVATIONS)
                            .withColumn("ingested_at", F.current_timestamp()), table, "series_id", 8, ["series_id", "observation_date"])
    all_files = set(spark.table(table).inputFiles())
    batch = spark.createDataFrame([("S7",), ("S7",), (None,)], "series_id string")
    near = catalog.rows_near(batch, table, "series_id", 8)
    assert len(all_files) == 8 and len(near.inputFiles()) == 1 and set(near.inputFiles()) < all_files
    assert near.where("series_id = 'S7'").count() == 3
    everything = spark.table(table).select("series_id")
    assert set(catalog.rows_near(everything, table, "series_id", 8).inputFiles()) == all_files
    new = spark.createDataFrame([(None,)], "series_id string")
    assert catalog.rows_near(new, table, "series_id", 8).count() == 0


def test_small_load_after_a_large_one(spark, scratch):
    from curvelake.sinks import writers as WR

    bronze, wh = f"{scratch}/bronze", Warehouse(f"{scratch}/wh-small")
    jobs.create_tables(spark, wh, buckets=8)
    ids = [f"S{i}" for i in range(60)]
    jobs.write_config(spark.createDataFrame([(s, s, "x", True) for s in ids], S.SERIES), wh.series)
    jobs.write_config(spark.createDataFrame([], S.COMPANIES), wh.companies)
    doc = lambda *values: '{"observations": [%s]}' % ", ".join(f'{{"date": "2026-01-0{d}", "value": "{v}"}}' for d, v in values)
    write = lambda day, rows: WR.write_bronze(spark.createDataFrame(rows, "entity_id string, ingest_date date, doc string"), bronze, "fred")
    write(D, [(s, D, doc((1, 1.5), (2, 2.5))) for s in ids])
    assert {r.source: r.silver_rows for r in jobs.run_daily(spark, bronze, wh, D).collect()}["fred"] == 120
    later = D + dt.timedelta(days=1)
    write(later, [("S7", later, doc((1, 9), (2, 9), (3, 3.5)))])
    for want in (1, 0):
        assert {r.source: r.silver_rows for r in jobs.run_daily(spark, bronze, wh, later).collect()}["fred"] == want
    got = {r.observation_date.day: str(r.value) for r in jobs.silver_observations(spark, wh).where("series_id = 'S7'").collect()}
    assert got == {1: "1.5000", 2: "2.5000", 3: "3.5000"}
