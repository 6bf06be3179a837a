"""A key holding a third of all rows: results stay exact and AQE splits the
hot partition of a shuffled join instead of giving it to one task."""

import contextlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

from curvelake.operators import gold
from curvelake.operators import relational as R
from curvelake.sources import tables as T
from tests.conftest import SF_CHECK

HOT = "0000000001"


def skewed_filings(spark):
    # every third order is re-assigned to one company: that cik holds ~1/3 of the rows
    o = T.table(spark, SF_CHECK, "orders")
    fil = T.filings(spark, SF_CHECK)
    key = F.substring_index("accession_number", "-", -1).cast("bigint")
    return fil.withColumn("cik", F.when(key % 3 == 0, F.lit(HOT)).otherwise(F.col("cik"))), o


@pytest.fixture()
def force_shuffled_joins(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_company_join_is_split_and_exact(spark, force_shuffled_joins):
    fil, _ = skewed_filings(spark)
    comp = T.companies(spark, SF_CHECK)
    j = R.join_filings_companies(fil, comp)
    got = {r.ticker: r["count"] for r in j.groupBy("ticker").count().collect()}
    j.collect()
    p = final_plan(j)
    assert "SortMergeJoin(skew=true)" in p and "AQEShuffleRead skewed" in p
    con = duckdb.connect()
    exp = dict(con.execute(f"""
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE CAST(o_custkey AS VARCHAR) END AS k
                   FROM read_parquet('{SF_CHECK}/orders.parquet'))
        SELECT 'T' || CAST(c_custkey AS VARCHAR), COUNT(*) FROM o
        JOIN read_parquet('{SF_CHECK}/customer.parquet') c ON o.k = CAST(c.c_custkey AS VARCHAR)
        WHERE o.k <> '0' OR o_orderkey % 3 = 0
        GROUP BY 1""").fetchall())
    exp = {k: v for k, v in exp.items()}
    assert got == exp
    assert got["T1"] > sum(got.values()) / 4


def test_hot_company_summary_is_exact(spark, force_shuffled_joins):
    fil, _ = skewed_filings(spark)
    s = {r.cik: r for r in gold.filings_summary(fil, T.companies(spark, SF_CHECK)).collect()}
    n_hot = fil.where(F.col("cik") == HOT).count()
    assert s[HOT].total_filings == n_hot
    assert s[HOT].annual_reports + s[HOT].quarterly_reports + s[HOT].current_reports == n_hot


def test_hot_key_in_upsert_source_last_wins(spark, force_shuffled_joins):
    """A third of all directory entries carry the same cik: the last one wins."""
    from curvelake.operators import silver as SV
    from curvelake.plans import documents as D
    from curvelake.sources import bronze as B

    c = T.table(spark, SF_CHECK, "customer")
    entries = c.select(F.col("c_custkey").alias("order"),
                       F.when(F.col("c_custkey") % 3 == 0, F.lit(1)).otherwise(F.col("c_custkey")).alias("cik_str"),
                       F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
                       F.col("c_name").alias("title"))
    rows = B.ticker_rows(B.parse_company_directory(D.render_company_directory(entries)))
    target = T.companies(spark, SF_CHECK).where("cik = '1'")
    out = {r.cik: r for r in SV.upsert_companies(target, rows).collect()}
    con = duckdb.connect()
    exp = dict(con.execute(f"""
        SELECT CAST(k AS VARCHAR), 'T' || CAST(arg_max(c_custkey, c_custkey) AS VARCHAR)
        FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE c_custkey END AS k, c_custkey
              FROM read_parquet('{SF_CHECK}/customer.parquet')) GROUP BY k""").fetchall())
    assert {k: r.ticker for k, r in out.items()} == exp
    assert out["1"].is_active == target.collect()[0].is_active      # flag kept for the known company
