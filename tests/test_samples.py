"""Unexpected values that a suite's results carry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curvelake import jobs
from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows
from curvelake.operators import constraints as C
from curvelake.operators import quality as Q
from tests.test_gold_store import load, obs

D = dt.date(2026, 1, 1)


def test_rows_carry_examples(spark):
    rows = [(D, "ok1", None), (D, "bad-2", None), (D, "bad-2", None), (None, "A", None), (D, None, None), (D, "X" * 21, None)]
    loose = S.T.StructType([S.T.StructField(f.name, f.dataType) for f in S.OBSERVATIONS.fields])
    df = literal_rows(spark, rows, loose)
    got = {r.expectation: r for r in Q.run_suite(df, Q.observation_suite(), samples=20).collect()}
    plain = {r.expectation: r for r in Q.run_suite(df, Q.observation_suite()).collect()}
    assert all(tuple(got[k])[:-1] == tuple(plain[k]) for k in plain)
    assert got["expect_column_values_to_match_regex"].unexpected_values == ["bad-2", "ok1"]
    assert got["expect_column_value_lengths_to_be_at_most"].unexpected_values == ["X" * 21]
    assert got["expect_compound_columns_to_be_unique"].unexpected_values == ['{"observation_date":"2026-01-01","series_id":"bad-2"}']
    assert got["expect_column_values_to_not_be_null"].unexpected_values == []


def test_columns_outside_the_key_and_no_key(spark):
    df = spark.createDataFrame([(f"a{i}", "1" * (10 + i % 3), "n", "f", D) for i in range(9)], S.FILINGS)
    for rules in (C.suite("filings"), [Q.expect_max_length("cik", 10)]):
        r = Q.run_suite(df, rules, samples=20).where("column = 'cik' AND expectation LIKE '%lengths%'").first()
        assert (r.unexpected_count, r.unexpected_values) == (6, ["1" * 11, "1" * 12])


def test_hot_and_many_bad_values_stay_bounded(spark):
    many = spark.range(60_000).select(F.lit(D).alias("observation_date"), F.lit(None).cast("decimal(10,4)").alias("value"),
                                      F.when(F.col("id") % 3 == 0, F.lit("hot-")).otherwise(F.format_string("v-%06d", "id")).alias("series_id"))
    suite = [e for e in Q.observation_suite() if "regex" in e.kind]
    res = Q.run_suite(many, suite, samples=20)
    r = res.first()
    assert (r.unexpected_count, len(r.unexpected_values)) == (60_000, 20) and "hot-" in r.unexpected_values
    rare = Q.run_suite(many.where("series_id <> 'hot-'"), suite, samples=20).first()
    assert len(set(rare.unexpected_values)) == 20
    few = Q.run_suite(many.where("id < 900"), suite, samples=20).first()
    assert few.unexpected_values == sorted({f"v-{i:06d}" for i in range(900) if i % 3} | {"hot-"})[:20]
    empty = Q.run_suite(many.limit(0), Q.observation_suite(), samples=5)
    assert all(r.unexpected_values == [] for r in empty.collect())


def test_one_scan(spark):
    plan = Q.run_suite(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.to_date("l_shipdate").alias("observation_date"), F.col("l_returnflag").alias("series_id"), F.lit(1).alias("value")),
        Q.observation_suite(), samples=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_stored_with_examples(spark, scratch):
    wh = jobs.Warehouse(f"{scratch}/wh-ex")
    load(spark, wh, obs=obs("bad id", [1], "1"))
    with pytest.raises(Q.QualityGateError, match="bad id"):
        jobs.validate(spark, wh, "r")
    stored = spark.read.parquet(wh.path("quality", "results")).where("expectation LIKE '%regex%'").first()
    assert stored.unexpected_values == ["bad id"]
