"""Physical-plan properties the design relies on (read from ``explain``)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from curvelake import schemas as S
from curvelake.operators import gold, relational as R, series as W
from curvelake.sinks import writers as WR
from curvelake.sources import tables as T
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    """The operator tree part of a formatted plan (details follow it)."""
    return p.split("\n\n(1)")[0]


@pytest.mark.parametrize("name", ["lag_change", "moving_avg_full", "quartile", "top_n_per_series",
                                  "percent_rank", "year_over_year", "rank_by_avg", "best_month",
                                  "date_gaps", "number_rows"])
def test_no_single_partition_exchange(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    if name == "rank_by_avg":
        # only the quantile sketches and the offset table (one row per range) meet in one task
        inputs = [part.rsplit("Exchange", 1)[1] for part in p.split("SinglePartition")[:-1]]
        assert inputs and all("percentile" in i or "buf#" in i or "_range" in i for i in inputs)
    elif name == "best_month":
        # final step of the scalar MAX: one partial maximum per partition
        assert p.count("SinglePartition") == 1
        before = p[:p.index("SinglePartition")].rsplit("Exchange", 1)[1]
        assert "Input [1]: [max#" in before
    else:
        assert "SinglePartition" not in p


def test_top_n_limits_before_the_shuffle(spark):
    p = plan(QUERIES["top_n_per_series"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2


def test_windows_with_one_spec_share_one_exchange(spark):
    p = plan(QUERIES["below_moving_avg"](spark, SF_SMALL))
    # one exchange for the binding aggregate, one for the window
    assert p.count("Exchange hashpartitioning") <= 2 or p.count("Exchange (") <= 2


def test_snapshot_is_one_aggregate_pass(spark):
    p = plan(QUERIES["daily_snapshot"](spark, SF_SMALL))
    assert "Join" not in tree(p) and tree(p).count("Scan parquet") == 1


def test_filters_and_projection_reach_the_scan(spark, scratch):
    path = f"{scratch}/silver"
    WR.layout_by_key(T.observations(spark, SF_SMALL), ["series_id", "observation_date"]) \
        .write.parquet(path)
    silver = spark.read.schema(S.OBSERVATIONS).parquet(path)
    p = plan(R.filter_series_eq(silver, "DGS10"))
    assert "PushedFilters: [IsNotNull(series_id), EqualTo(series_id,DGS10)]" in p
    p = plan(R.filter_like_prefix(silver).select("series_id"))
    assert "StringStartsWith(series_id,DGS)" in p and "ReadSchema: struct<series_id:string>" in p
    p = plan(R.topk_latest(silver))
    assert "TakeOrderedAndProject" in p


def test_observation_dedupe_is_a_hash_aggregate(spark):
    p = plan(QUERIES["silver_observations"](spark, SF_SMALL))
    assert "SortAggregate" not in p


def test_quality_suite_scans_once(spark, scratch):
    path = f"{scratch}/silver-q"
    T.observations(spark, SF_SMALL).write.parquet(path)
    from curvelake.operators import quality as Q
    p = plan(Q.run_suite(spark.read.parquet(path), Q.observation_suite()))
    assert tree(p).count("Scan parquet") == 1


def test_scalar_subqueries_not_cross_joins(spark):
    for name in ("above_global_avg", "pct_of_total", "best_month", "bronze_error_documents"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_filings_summary_aggregates_before_the_join(spark):
    p = plan(QUERIES["filings_summary"](spark, SF_SMALL))
    join_at = p.index("Join Inner")
    assert "HashAggregate" in p[join_at:]   # an aggregate sits below the company join


def test_series_seed_and_upsert(spark):
    from curvelake.operators import silver as SV
    seed = T.series(spark)
    assert seed.count() == 18 and seed.select("category").distinct().count() == 5
    upd = spark.createDataFrame([("DGS10", "10-Year Treasury CMT", "treasury"),
                                 ("DFF", "Federal Funds Rate Daily", "policy")],
                                "series_id string, name string, category string")
    out = {r.series_id: r for r in SV.upsert_series(seed, upd).collect()}
    assert len(out) == 19 and out["DGS10"].name == "10-Year Treasury CMT"
    assert out["DFF"].is_active is True and out["TEDRATE"].is_active is False


def test_views_resolve_in_sql(spark):
    from curvelake.plans.views import register_views
    names = register_views(spark, T.observations(spark, SF_SMALL), T.filings(spark, SF_SMALL),
                           T.companies(spark, SF_SMALL))
    for n in names:
        spark.sql(f"SELECT * FROM {n}").limit(1).collect()
    df = spark.sql("SELECT * FROM gold_full_yield_curve WHERE observation_date >= DATE '1998-01-01'")
    assert df.where(F.col("observation_date") < "1998-01-01").count() == 0
    assert "LessThan" not in plan(W.lag_change(T.observations(spark, SF_SMALL)))
    assert gold.daily_snapshot(T.observations(spark, SF_SMALL)).columns == \
        spark.table("gold_daily_snapshot").columns


def test_scale_conf_sizes_by_input_and_cluster():
    from curvelake.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2)
    small = scale_conf(10 * 1024 ** 3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120          # 3 waves of 40 cores


def test_bucketed_silver_avoids_shuffling_silver(spark, scratch):
    """Windows and the key check read bucketed silver without an exchange; the
    anti-join of a load shuffles only the batch."""
    from curvelake.jobs import _CO_PARTITION, Warehouse, create_tables
    from curvelake.session import setting
    from curvelake.operators import merge as M
    from curvelake.operators import quality as Q
    from curvelake.sinks.catalog import append_bucketed, layout

    wh = Warehouse(f"{scratch}/wh-bucketed")
    obs_table, _ = create_tables(spark, wh, buckets=8)
    o = T.observations(spark, SF_SMALL)
    append_bucketed(o.withColumn("ingested_at", F.current_timestamp()), obs_table, "series_id",
                    layout(spark, wh.root).observation_buckets, ["series_id", "observation_date"])
    silver = spark.table(obs_table).drop("ingested_at")
    p = plan(W.lag_change(silver))
    assert "Exchange" not in tree(p) and "Bucketed: true" in p
    p = plan(Q.run_suite(silver, Q.observation_suite()))
    assert tree(p).count("Exchange") == 1 and "SinglePartition" in p      # only the final global sum
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        with setting(spark, *_CO_PARTITION):      # as a load does it
            p = plan(M.insert_if_absent(o.repartition(8, "series_id"), spark.table(obs_table), ["observation_date", "series_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "Bucketed: true" in p
    assert "Arguments: hashpartitioning(series_id" in p                  # the batch, into the buckets
    assert p.count("Arguments: hashpartitioning") == 2                   # + the binding's own aggregate


def test_load_combines_revisions_before_the_shuffle(spark):
    """First-wins is a partial aggregate below the exchange, over series and date."""
    from curvelake.operators import silver as SV
    from curvelake.plans import catalog as C

    docs = C.B.parse_observation_docs(C._observation_docs(spark, SF_SMALL))
    p = plan(SV.load_observations(docs, C._existing_silver(spark, SF_SMALL), buckets=8).new_rows)
    part = p[p.index("partial_min_by"):]
    assert "hashpartitioning(observation_date" in part and part.index("hashpartitioning(observation_date") < part.index("min_by(")\
        or "partial_min_by" in p.split("REPARTITION_BY_NUM")[0]


def test_date_maximum_is_joined_on_both_keys(spark):
    import re

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES["join_date_max"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"hashpartitioning\((?:_d|observation_date)#\d+, (?:_max|value)#\d+", p)) == 2


def test_share_of_total_scans_once(spark):
    df = QUERIES["wide_pct_of_total"](spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in plan(df) or tree(plan(df)).count("Scan parquet") == 1


def test_key_layout_skips_files(spark, scratch):
    """A filter on one series touches few of the files: their value ranges do not overlap."""
    path = f"{scratch}/ranges"
    WR.layout_by_key(T.observations_wide(spark, SF_SMALL), ["series_id", "observation_date"]).write.option(
        "maxRecordsPerFile", 200).parquet(path)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("series_id").alias("lo"), F.max("series_id").alias("hi"))
    n, hit = spans.count(), spans.where("'P100' BETWEEN lo AND hi").count()
    assert n > 10 and hit <= 2


def test_session_settings_stay_as_they_were(spark, scratch):
    from curvelake.jobs import Warehouse, create_tables

    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    create_tables(spark, Warehouse(f"{scratch}/wh-conf"))
    assert spark.conf.get(key) == before == "true"


def test_validate_computes_the_suite_once(spark, scratch, monkeypatch):
    from curvelake import jobs

    wh = jobs.Warehouse(f"{scratch}/wh-once")
    jobs.create_tables(spark, wh)
    calls, run = [], jobs.Q.run_suite

    def counted(df, rules, **options):
        out = run(df, rules, **options)
        real = out.collect
        object.__setattr__(out, "collect", lambda: calls.append(1) or real())
        return out
    monkeypatch.setattr(jobs.Q, "run_suite", counted)
    assert jobs.validate(spark, wh, "once").count() == 8 and calls == [1]
