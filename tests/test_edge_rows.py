"""Hand-made edge rows: the rules the source system's loaders and views encode."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.operators import aggregates as A
from curvelake.operators import gold
from curvelake.operators import merge as M
from curvelake.operators import quality as Q
from curvelake.operators import series as W
from curvelake.operators import silver as SV
from curvelake.sources import bronze as B


def d(s):
    return dt.date.fromisoformat(s)


def obs_df(spark, rows):
    return spark.createDataFrame([(d(a), b, None if c is None else D(c)) for a, b, c in rows], S.OBSERVATIONS)


def obs_docs(spark, docs):
    """[(series_id, ingest_date, dict)] -> parsed documents."""
    df = spark.createDataFrame([(sid, d(day), json.dumps(doc)) for sid, day, doc in docs],
                               "entity_id string, ingest_date date, doc string")
    return B.parse_observation_docs(df)


def doc(*pairs):
    return {"observations": [{"date": a, "value": b, "realtime_start": a, "realtime_end": a} for a, b in pairs]}


# --- bronze -> silver --------------------------------------------------------

def test_missing_marker_dropped_and_bad_values_rejected(spark):
    docs = obs_docs(spark, [("DGS10", "2026-01-27", doc(
        ("2026-01-27", "4.25"), ("2026-01-26", "."), ("2026-01-23", "abc"),
        ("2026-01-22", "4.23455"), ("2026-01-21", "-4.23455"), ("2026-01-20", "12345678")))])
    empty = spark.createDataFrame([], S.OBSERVATIONS)
    load = SV.load_observations(docs, empty)
    got = {(r.observation_date.isoformat(), r.value) for r in load.new_rows.collect()}
    assert got == {("2026-01-27", D("4.2500")), ("2026-01-22", D("4.2346")), ("2026-01-21", D("-4.2346"))}
    rej = sorted((r.raw_value, r.reject_reason) for r in load.rejects.collect())
    assert rej == [("12345678", "bad value"), ("abc", "bad value")]


def test_error_document_yields_no_rows(spark):
    docs = obs_docs(spark, [("DGS2", "2026-01-27", {"error_code": 400, "error_message": "Bad Request"})])
    assert B.observation_rows(docs).count() == 0
    assert SV.error_documents(docs).count() == 1


def test_revised_value_is_ignored_first_wins(spark):
    silver = obs_df(spark, [("2026-01-27", "DGS10", "4.2500")])
    docs = obs_docs(spark, [
        ("DGS10", "2026-01-28", doc(("2026-01-27", "4.9900"), ("2026-01-28", "4.3000"))),
        ("DGS10", "2026-01-29", doc(("2026-01-28", "4.4000"))),
    ])
    new = SV.load_observations(docs, silver).new_rows.collect()
    assert [(r.observation_date.isoformat(), r.value) for r in new] == [("2026-01-28", D("4.3000"))]
    # loading the result again inserts nothing
    silver2 = silver.unionByName(SV.load_observations(docs, silver).new_rows)
    assert SV.load_observations(docs, silver2).new_rows.count() == 0


def filing_doc(acc, forms, dates, cik="0000320193", name="Apple Inc."):
    return {"cik": cik, "name": name,
            "filings": {"recent": {"accessionNumber": acc, "form": forms, "filingDate": dates}}}


def test_unequal_arrays_and_missing_levels(spark):
    docs = spark.createDataFrame([
        (d("2026-01-27"), json.dumps(filing_doc(["A-1", "A-2"], ["10-K"], ["2026-01-15", "2026-01-16"]))),
        (d("2026-01-27"), json.dumps({"cik": "0000000001", "name": "No filings"})),
        (d("2026-01-27"), json.dumps({"cik": "0000000002", "name": "No recent", "filings": {}})),
        (d("2026-01-27"), json.dumps(filing_doc(["B-1"], ["8-K", "10-Q"], ["2026-01-02", "2026-01-03"],
                                                cik="0000000003"))),
    ], "ingest_date date, doc string")
    parsed = B.parse_filing_docs(docs)
    empty = spark.createDataFrame([], S.FILINGS)
    load = SV.load_filings(parsed, empty)
    assert sorted((r.accession_number, r.filing_type) for r in load.new_rows.collect()) == \
        [("A-1", "10-K"), ("B-1", "8-K")]
    assert [(r.accession_number, r.reject_reason) for r in load.rejects.collect()] == [("A-2", "unequal arrays")]


def test_two_tickers_one_cik_last_wins_flag_untouched(spark):
    directory = spark.createDataFrame([(json.dumps({
        "0": {"cik_str": 1652044, "ticker": "GOOGL", "title": "Alphabet Inc."},
        "1": {"cik_str": 1652044, "ticker": "GOOG", "title": "Alphabet Inc."},
        "2": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."},
    }),)], "doc string").withColumn("entity_id", F.lit("tickers"))
    rows = B.ticker_rows(B.parse_company_directory(directory))
    target = spark.createDataFrame([("1652044", "GOOGL", "ALPHABET", False)], S.COMPANIES)
    out = {r.cik: r for r in SV.upsert_companies(target, rows).collect()}
    assert out["1652044"].ticker == "GOOG" and out["1652044"].name == "Alphabet Inc."
    assert out["1652044"].is_active is False          # not touched by the update
    assert out["320193"].is_active is True            # new row: default


def test_upsert_writes_source_nulls(spark):
    target = spark.createDataFrame([("DGS10", "10y", "treasury", True)], S.SERIES)
    src = spark.createDataFrame([("DGS10", None, "rates")], "series_id string, name string, category string")
    r = M.upsert(target, src, S.SERIES_KEY, ["name", "category"]).collect()[0]
    assert (r.name, r.category, r.is_active) == (None, "rates", True)
    with pytest.raises(Exception, match="NOT NULL"):    # the config table declares its name NOT NULL
        SV.upsert_series(target, src).collect()


def test_upsert_source_with_a_key_twice(spark):
    target = spark.createDataFrame([("DGS10", "10y", "treasury", True)], S.SERIES)
    src = spark.createDataFrame([("DGS10", "a", "x", 1), ("DGS10", "b", "y", 2), ("NEW", "n", "z", 1)],
                                "series_id string, name string, category string, pos int")
    with pytest.raises(Exception, match="duplicate key"):
        SV.upsert_series(target, src).collect()
    got = {r.series_id: r.name for r in SV.upsert_series(target, src, order=["pos"]).collect()}
    assert got == {"DGS10": "b", "NEW": "n"}


def test_insert_key_twice_raises(spark):
    comp = spark.createDataFrame([("1", "A", "a", True)], S.COMPANIES)
    rows = spark.createDataFrame([("2", "B", "b"), ("2", "C", "c")], "cik string, ticker string, name string")
    with pytest.raises(Exception, match="duplicate key"):
        M.insert_rows(comp, rows, S.COMPANIES_KEY, {"is_active": F.lit(True)}).collect()


def test_insert_existing_key_raises(spark):
    comp = spark.createDataFrame([("320193", "AAPL", "Apple", True)], S.COMPANIES)
    row = spark.createDataFrame([("320193", "AAPL2", "Apple 2")], "cik string, ticker string, name string")
    with pytest.raises(Exception, match="duplicate key"):
        M.insert_rows(comp, row, S.COMPANIES_KEY, {"is_active": F.lit(True)}).collect()


def test_ends_of_short_and_long_series(spark):
    from curvelake.operators.aggregates import array_agg_ordered, ordered_ends

    rows = [(dt.date(2026, 1, d), s, D(d)) for s, days in (("A", [5]), ("B", [3, 1]), ("C", range(1, 29))) for d in days]
    obs = spark.createDataFrame(rows, S.OBSERVATIONS)
    ends = {r.series_id: ([x.value for x in r.first_n], [x.value for x in r.last_n]) for r in ordered_ends(obs, 3).collect()}
    assert ends == {"A": ([5], [5]), "B": ([1, 3], [3, 1]), "C": ([1, 2, 3], [28, 27, 26])}
    got = {r.series_id: (r.first_value, r.second_value, r.last_but_one_value, r.last_value) for r in array_agg_ordered(obs).collect()}
    assert got == {"A": (5, None, None, 5), "B": (1, 3, 1, 3), "C": (1, 2, 27, 28)}


# --- gold ----------------------------------------------------------------------

def test_documented_curve_sample(spark):
    o = obs_df(spark, [("2026-01-23", "DGS2", "3.60"), ("2026-01-23", "DGS10", "4.24"), ("2026-01-23", "DGS30", "4.82"),
                       ("2026-01-22", "DGS2", "3.61"), ("2026-01-22", "DGS10", "4.26"), ("2026-01-22", "DGS30", "4.84")])
    got = {r.observation_date.isoformat(): (r.yield_2y, r.yield_10y, r.yield_30y, r.spread_2s10s)
           for r in gold.yield_curve(o).collect()}
    assert got["2026-01-23"] == (D("3.6000"), D("4.2400"), D("4.8200"), D("0.6400"))
    assert got["2026-01-22"] == (D("3.6100"), D("4.2600"), D("4.8400"), D("0.6500"))


def test_snapshot_labels_and_thresholds(spark):
    o = obs_df(spark, [
        ("2026-01-01", "DGS2", "4.00"), ("2026-01-01", "DGS10", "4.00"),              # spread 0 -> FLAT
        ("2026-01-02", "DGS2", "4.00"), ("2026-01-02", "DGS10", "4.25"),              # 0.25 -> NORMAL
        ("2026-01-03", "DGS2", "4.10"), ("2026-01-03", "DGS10", "4.00"),              # < 0 -> INVERTED
        ("2026-01-04", "DGS10", "4.00"),                                              # no 2y -> NORMAL
        ("2026-01-01", "BAMLH0A0HYM2", "8.0"),                                        # 0.80 -> LOW
        ("2026-01-02", "BAMLH0A0HYM2", "5.0"), ("2026-01-02", "VIXCLS", "40"),        # 1.50 -> ELEVATED
        ("2026-01-03", "BAMLH0A0HYM2", "5.0"), ("2026-01-03", "VIXCLS", "40.4"),      # 1.51 -> HIGH
        ("2026-01-05", "VIXCLS", "20"),                                               # no treasury row: not in snapshot
    ])
    got = {r.observation_date.isoformat(): (r.curve_status, r.stress_score, r.stress_level)
           for r in gold.daily_snapshot(o).collect()}
    assert got == {
        "2026-01-01": ("FLAT", D("0.80"), "LOW"),
        "2026-01-02": ("NORMAL", D("1.50"), "ELEVATED"),
        "2026-01-03": ("INVERTED", D("1.51"), "HIGH"),
        "2026-01-04": ("NORMAL", D("0.00"), "LOW"),
    }
    composed = {r.observation_date.isoformat(): (r.curve_status, r.stress_score, r.stress_level)
                for r in gold.daily_snapshot_composed(o).collect()}
    assert composed == got


def test_padded_cik_joins(spark):
    fil = spark.createDataFrame([("A-1", "0000320193", "Apple", "10-K", d("2026-01-15")),
                                 ("A-2", "0000320193", "Apple", "8-K", d("2026-01-20")),
                                 ("Z-1", "0000000000", "Zero", "8-K", d("2026-01-20"))], S.FILINGS)
    comp = spark.createDataFrame([("320193", "AAPL", "Apple Inc.", True), ("0", "ZERO", "Zero", True)], S.COMPANIES)
    r = gold.filings_summary(fil, comp).collect()
    assert len(r) == 1 and r[0].ticker == "AAPL" and r[0].total_filings == 2
    assert (r[0].annual_reports, r[0].quarterly_reports, r[0].current_reports) == (1, 0, 1)


# --- windows ---------------------------------------------------------------------

def test_first_row_and_short_frames(spark):
    rows = [(f"2026-01-0{i}", "DGS10", str(4 + i / 100)) for i in range(1, 9)]
    o = obs_df(spark, rows)
    lag = sorted(W.lag_change(o).collect(), key=lambda r: r.observation_date)
    assert lag[0].direction == "N/A" and lag[1].direction == "positive"
    rf = sorted(W.rising_flag(o).collect(), key=lambda r: r.observation_date)
    assert rf[0].flag == 0 and rf[1].flag == 1
    assert W.moving_avg_full(o).count() == 2          # 8 rows, frames of 7 from row 7
    assert W.moving_avg_partial(o).count() == 8
    sd = sorted(W.moving_stddev(o).collect(), key=lambda r: r.observation_date)
    assert sd[0].moving_stddev is None and sd[1].moving_stddev is not None


def test_rank_ties_and_nth(spark):
    o = obs_df(spark, [("2026-01-01", "A", "2"), ("2026-01-01", "B", "2"), ("2026-01-01", "C", "1"),
                       ("2026-01-02", "C", "1"), ("2026-01-01", "ONE", "0.5")])
    ranks = {r.series_id: (r.rank_with_gaps, r.rank_without_gaps) for r in A.rank_by_avg(o).collect()}
    assert ranks == {"A": (1, 1), "B": (1, 1), "C": (3, 2), "ONE": (4, 3)}
    assert {r.series_id for r in W.second_highest(o).collect()} == {"C"}   # 1-row series give no row


def test_global_rank_across_many_partitions(spark):
    from curvelake.operators.ranking import global_rank
    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 37).alias("k"))
    got = global_rank(df, "k", descending=False).select("k", "rank", "dense_rank").distinct()
    for r in got.collect():
        assert r.dense_rank == r.k + 1
        assert r.rank == 1 + sum(len(range(j, 2000, 37)) for j in range(r.k))


def test_missing_year_and_best_month_tie(spark):
    o = obs_df(spark, [("2020-01-01", "S", "1"), ("2022-01-01", "S", "3"),
                       ("2021-03-01", "T", "5"), ("2021-04-01", "T", "5")])
    yoy = {r.year: r.prev_year_avg_yield for r in W.year_over_year(o, ["S"]).collect()}
    assert yoy == {2020: None, 2022: 1.0}
    assert sorted((r.year, r.month) for r in A.best_month(o).collect()) == [(2021, 3), (2021, 4)]


# --- quality ---------------------------------------------------------------------

def test_suite_flags_bad_ids_and_gate_raises(spark):
    o = spark.createDataFrame([(d("2026-01-01"), "DGS10", D("1")), (d("2026-01-01"), "dgs10", D("1")),
                               (d("2026-01-01"), "A B", D("1")), (d("2026-01-02"), None, D("1")),
                               (d("2026-01-01"), "DGS10", D("2"))],
                              "observation_date date, series_id string, value decimal(10,4)")
    res = {(r.expectation, r.column): r for r in Q.run_suite(o, Q.observation_suite()).collect()}
    assert res[("expect_column_values_to_match_regex", "series_id")].unexpected_count == 2
    assert res[("expect_column_values_to_not_be_null", "series_id")].unexpected_count == 1
    assert res[("expect_compound_columns_to_be_unique", "observation_date,series_id")].unexpected_count == 2
    assert res[("expect_column_to_exist", "value")].success
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_suite(o, Q.observation_suite()))


def test_missing_column_fails_existence(spark):
    o = spark.createDataFrame([(d("2026-01-01"), "DGS10")], "observation_date date, series_id string")
    res = {(r.expectation, r.column): r.success for r in Q.run_suite(o, Q.observation_suite()).collect()}
    assert res[("expect_column_to_exist", "value")] is False
    assert res[("expect_column_to_exist", "series_id")] is True


def test_global_rank_with_adaptive_ranges(spark):
    from curvelake.operators.ranking import global_rank
    df = spark.range(0, 50000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"))
    got = global_rank(df, "k", descending=True).select("k", "rank", "dense_rank").distinct().collect()
    assert len(got) == 1000
    for r in got:   # every key occurs 50 times
        assert (r.rank, r.dense_rank) == (1 + 50 * (999 - r.k), 1000 - r.k)


def test_literal_date_range(spark):
    from curvelake.operators.relational import date_series
    days = [r.dt for r in date_series(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 7)).collect()]
    assert days == [dt.date(2024, 1, i) for i in range(1, 8)]


def test_missing_form_array_is_rejected_in_both_ansi_modes(spark):
    docs = spark.createDataFrame([(d("2026-01-27"), json.dumps(
        {"cik": "0000000009", "name": "No forms",
         "filings": {"recent": {"accessionNumber": ["C-1"], "filingDate": ["2026-01-02"]}}}))],
        "ingest_date date, doc string")
    empty = spark.createDataFrame([], S.FILINGS)
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            load = SV.load_filings(B.parse_filing_docs(docs), empty)
            assert load.new_rows.count() == 0, ansi
            assert [r.reject_reason for r in load.rejects.collect()] == ["unequal arrays"], ansi
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_global_rank_nulls_first_descending(spark):
    from curvelake.operators.ranking import global_rank
    df = spark.createDataFrame([("a", None), ("b", None), ("c", 3.0), ("d", 2.0), ("e", 3.0)], "id string, k double")
    got = {r.id: (r.rank, r.dense_rank) for r in global_rank(df, "k", descending=True).collect()}
    assert got == {"a": (1, 1), "b": (1, 1), "c": (3, 2), "e": (3, 2), "d": (5, 3)}
