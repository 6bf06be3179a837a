"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Every entry reads the given tables (through the bindings in
``curvelake.sources.tables``) over their whole extent.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal as _D

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows
from curvelake import jobs
from curvelake.jobs import Warehouse
from curvelake.operators import aggregates as A
from curvelake.operators import constraints as C
from curvelake.operators import gold
from curvelake.operators import merge as M
from curvelake.operators import quality as Q
from curvelake.operators import relational as R
from curvelake.operators import series as W
from curvelake.operators import silver as SV
from curvelake.plans import documents as D
from curvelake.plans.views import register_views, register_warehouse
from curvelake.session import scratch_path
from curvelake.sinks import gold_store as GS
from curvelake.sinks import validation_store as VS
from curvelake.sinks import writers as WR
from curvelake.sinks.catalog import append_bucketed, layout
from curvelake.sources import bronze as B
from curvelake.sources import tables as T
from curvelake.streaming.bronze_stream import stream_bronze_to_silver

#: companies named in the IN-list queries (the oracle writes them out again)
IN_LIST_TICKERS = ["T1", "T2", "T3", "T5", "T8", "T13"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- 2.E gold ---------------------------------------------------------------

@register("pivot_yield_curve")
def _q(spark, d):
    return gold.yield_curve(T.observations(spark, d))


@register("pivot_full_curve")
def _q(spark, d):
    return gold.full_yield_curve(T.observations(spark, d))


@register("credit_stress")
def _q(spark, d):
    return gold.credit_stress(T.observations(spark, d))


@register("daily_snapshot")
def _q(spark, d):
    return gold.daily_snapshot(T.observations(spark, d))


@register("filings_summary")
def _q(spark, d):
    return gold.filings_summary(T.filings(spark, d), T.companies(spark, d))


# --- 2.F windows (all series; series=['DGS10'] gives the single-series form)


for _name, _fn in {
    "lag_change": W.lag_change,
    "running_total": W.running_total,
    "moving_avg_full": W.moving_avg_full,
    "moving_avg_partial": W.moving_avg_partial,
    "below_moving_avg": W.below_moving_avg,
    "moving_stddev": W.moving_stddev,
    "running_count": W.running_count,
    "quartile": W.quartile,
    "second_highest": W.second_highest,
    "third_highest": W.third_highest,
    "rising_flag": W.rising_flag,
    "next_value": W.next_value,
    "year_over_year": W.year_over_year,
    "date_gaps": W.date_gaps,
    "repeated_values": W.repeated_values,
    "percent_rank": W.percent_rank,
    "number_rows": W.number_rows,
    "join_rownum_series": R.join_rownum_series,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, d: fn(T.observations(spark, d)))(_fn)


@register("top_n_per_series")
def _q(spark, d):
    return W.top_n_per_series(T.observations(spark, d), 3)


# --- 2.E aggregates ---------------------------------------------------------


for _name, _fn in {
    "series_stats": A.series_stats,
    "count_per_series": A.count_per_series,
    "global_avg": A.global_avg,
    "pct_of_total": A.pct_of_total,
    "join_grand_total": R.join_grand_total,
    "avg_by_year": A.avg_by_month,
    "best_month": A.best_month,
    "first_last": A.first_last,
    "array_agg_ordered": A.array_agg_ordered,
    "distinct_above": A.distinct_above,
    "grouping_sets": A.grouping_sets,
    "rollup": A.rollup,
    "cube": A.cube,
    "rank_by_avg": A.rank_by_avg,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, d: fn(T.observations(spark, d)))(_fn)


# --- 2.C / 2.D / 2.G / 2.H relational --------------------------------------


for _name, _fn in {
    "project_staging": R.project_staging,
    "filter_series_eq": R.filter_series_eq,
    "filter_like_prefix": R.filter_like_prefix,
    "filter_gt_const": R.filter_gt_const,
    "join_scalar_avg": R.join_scalar_avg,
    "join_date_max": R.join_date_max,
    "above_global_avg": R.above_global_avg,
    "topk_latest": R.topk_latest,
    "date_series": R.series_calendar,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, d: fn(T.observations(spark, d)))(_fn)


@register("filter_in_list")
def _q(spark, d):
    return R.filter_in_list(T.companies(spark, d), "ticker", IN_LIST_TICKERS)


@register("filter_flag")
def _q(spark, d):
    return R.filter_flag(T.companies(spark, d))


@register("join_filings_companies")
def _q(spark, d):
    return R.join_filings_companies(T.filings(spark, d), T.companies(spark, d))


@register("join_curve_stress")
def _q(spark, d):
    return gold.daily_snapshot_composed(T.observations(spark, d))


@register("limit_view")
def _q(spark, d):
    return R.limit_view(gold.yield_curve(T.observations(spark, d)), 10)


@register("table_row_counts")
def _q(spark, d):
    return R.table_row_counts({"treasury_yields": T.observations(spark, d),
                               "sec_filings": T.filings(spark, d)})


@register("case_label")
def _q(spark, d):
    """Label coverage of the snapshot: rows per (curve_status, stress_level)."""
    s = gold.daily_snapshot(T.observations(spark, d))
    return s.groupBy("curve_status", "stress_level").agg(F.count(F.lit(1)).alias("days"))


@register("case_flag")
def _q(spark, d):
    """Rising days per series (the 1/0 CASE flag, summed)."""
    r = W.rising_flag(T.observations(spark, d))
    return r.groupBy("series_id").agg(F.sum("flag").cast("bigint").alias("rising_days"))


# --- 2.A / 2.B / 2.J bronze -> silver (documents held in memory) -----------
#
# Documents are rendered from the bound tables and parsed back; edge cases are
# injected by data rules, identical in the oracle SQL:
#   day 15                 -> value "." (missing: dropped)
#   29 February            -> value "n/a" (malformed: rejected)
#   dates before CUTOFF    -> already in silver; the documents carry revised
#                             values (+0.01) that must be ignored
#   filing day 13          -> the last form slot of the document is missing
#                             (unequal arrays: that accession is rejected)
#   documents of ERROR_YEAR (bronze_error_documents only) -> error payload


CUTOFF = _dt.date(1998, 1, 1)
ERROR_YEAR = "1999"
DAY1, DAY2, DAY3 = _dt.date(2026, 1, 27), _dt.date(2026, 1, 28), _dt.date(2026, 1, 29)


def _raw_observation_strings(obs: DataFrame, revise: bool = True) -> DataFrame:
    d = F.col("observation_date")
    value = F.col("value")
    if revise:
        value = F.when(d < F.lit(CUTOFF), value + F.lit(_D("0.0100"))).otherwise(value)
    v = (F.when(F.dayofmonth(d) == 15, F.lit(S.MISSING_MARKER))
         .when((F.month(d) == 2) & (F.dayofmonth(d) == 29), F.lit("n/a"))
         .otherwise(value.cast("string")))
    return obs.select("series_id", F.date_format(d, "yyyy-MM-dd").alias("date"), v.alias("value"))


def _observation_docs(spark, d, revise=True, ingest=DAY1):
    return D.render_observation_docs(_raw_observation_strings(T.observations(spark, d), revise),
                                     F.lit(ingest))


def _existing_silver(spark, d):
    o = T.observations(spark, d)
    return o.where(F.col("observation_date") < F.lit(CUTOFF))


@register("src_bronze_observations")
def _q(spark, d):
    rows = B.observation_rows(B.parse_observation_docs(_observation_docs(spark, d)))
    return rows.select("series_id", "date", "value")


@register("filter_missing_marker")
def _q(spark, d):
    rows = B.observation_rows(B.parse_observation_docs(_observation_docs(spark, d)))
    return SV.filter_missing_marker(rows).select("series_id", "date", "value")


@register("silver_observations")
def _q(spark, d):
    silver = _existing_silver(spark, d)
    load = SV.load_observations(B.parse_observation_docs(_observation_docs(spark, d)), silver)
    return silver.unionByName(load.new_rows)


@register("silver_observation_rejects")
def _q(spark, d):
    load = SV.load_observations(B.parse_observation_docs(_observation_docs(spark, d)),
                                _existing_silver(spark, d))
    return load.rejects.select("series_id", "raw_date", "raw_value", "reject_reason")


@register("merge_new_observations")
def _q(spark, d):
    o = T.observations(spark, d)
    revised = o.select("observation_date", "series_id",
                       (F.col("value") + F.lit(_D("0.0100"))).cast(S.VALUE_TYPE).alias("value"))
    return M.merge_insert_if_absent(_existing_silver(spark, d), revised, S.OBSERVATIONS_KEY)


@register("bronze_error_documents")
def _q(spark, d):
    docs = _observation_docs(spark, d)
    y = F.get_json_object("doc", "$.observations[0].date").substr(1, 4)
    docs = docs.withColumn("doc", F.when(y == ERROR_YEAR, F.lit('{"error_code": 400, "error_message": "Bad Request"}'))
                           .otherwise(F.col("doc")))
    parsed = B.parse_observation_docs(docs)
    payload = F.col("observations")
    return parsed.agg(F.count(F.lit(1)).alias("documents"),
                      F.count_if(payload.isNull()).alias("error_documents"),
                      F.coalesce(F.sum(B.array_len(payload)), F.lit(0)).cast("bigint").alias("observation_rows"))


#: bodies of failed fetches, and the kind of error each is
BAD_BODIES = ("<html>503</html>", '{"error_code": 400, "error_message": "Bad Request"}', '{"observations": "none", "error_message": "odd"}')


@register("bronze_error_reasons")
def _q(spark, d):
    """Documents of both sources without their payload: not JSON, JSON without it, or with something
    else in its place; entries by source and reason, with the message that some carry."""
    bodies = F.array(*[F.lit(b) for b in BAD_BODIES])
    docs = {"fred": _observation_docs(spark, d), "sec": D.render_filing_docs(T.filings(spark, d), F.lit(DAY1))}
    out = []
    for source, df in docs.items():
        n = F.length(B.ENTITY) + F.ascii(F.substring(B.ENTITY, -1, 1))
        bad = df.withColumn("doc", F.when(n % 4 < 3, F.get(bodies, n % 4)).otherwise(F.col("doc")))
        if source == "sec":
            bad = bad.withColumn("doc", F.replace("doc", F.lit('"observations"'), F.lit('"filings"')))
        payload = (F.from_json("doc", S.OBSERVATION_DOC)["observations"], "observations") if source == "fred" else (
            F.from_json("doc", S.FILING_DOC)["filings"], "filings")
        out.append(bad.select(F.lit(source).alias("source"), F.coalesce(B.document_error(*payload), F.lit("good")).alias("error"),
                              B.document_message().alias("message"))
                   .groupBy("source", "error", "message").agg(F.count(F.lit(1)).alias("documents")))
    return out[0].unionByName(out[1])


@register("job_rejects")
def _q(spark, d):
    """The reject log after three loads of one day: documents with a bad value, the same again, and a
    rewrite whose values are bad in another way at the same places; with the run that logged each."""
    base = scratch_path(spark, "reject-log")
    bronze, wh = f"{base}/bronze", Warehouse(f"{base}/warehouse")
    o = T.observations(spark, d)
    jobs.write_config(T.series(spark), wh.series)
    jobs.write_config(T.companies(spark, d), wh.companies)
    for load, bad in enumerate(("n/a", None, "1e99")):
        if bad:
            odd = F.when(F.dayofmonth("observation_date") == 3, F.lit(bad)).otherwise(F.col("value").cast("string"))
            rows = o.select("series_id", F.date_format("observation_date", "yyyy-MM-dd").alias("date"), odd.alias("value"))
            WR.write_bronze(D.render_observation_docs(rows, F.lit(DAY1)), bronze, "fred")
        jobs.run_daily(spark, bronze, wh, DAY1)
    runs = jobs.runs(spark, wh).where("source = 'fred'").select("run_id", F.row_number().over(Window.orderBy("run_id")).alias("load"))
    log = spark.read.parquet(wh.path("silver", "_rejects", "observations"))
    return log.join(runs, "run_id").select("load", "series_id", "raw_date", "raw_value", "reject_reason")


@register("job_backfill")
def _q(spark, d):
    """Bronze of three ingest days, of which the job loads the first two: first wins by ingest
    day, and the third day's document is not read."""
    base = scratch_path(spark, "backfill-job")
    bronze, wh = f"{base}/bronze", Warehouse(f"{base}/warehouse")
    o = T.observations(spark, d)
    early = o.where(F.col("observation_date") < F.lit(CUTOFF))
    WR.write_bronze(D.render_observation_docs(_raw_observation_strings(early, revise=False), F.lit(DAY1)), bronze, "fred")
    WR.write_bronze(D.render_observation_docs(_raw_observation_strings(o, revise=True), F.lit(DAY2)), bronze, "fred")
    later = o.select("series_id", F.date_format(F.date_add("observation_date", 20_000), "yyyy-MM-dd").alias("date"),
                     F.lit("9.99").alias("value"))
    WR.write_bronze(D.render_observation_docs(later, F.lit(DAY3)), bronze, "fred")
    jobs.write_config(T.series(spark), wh.series)
    jobs.write_config(T.companies(spark, d), wh.companies)
    jobs.backfill(spark, bronze, wh, DAY1, DAY2)
    return jobs.silver_observations(spark, wh).drop("ingested_at")


# filings

def _filing_docs(spark, d):
    fil = T.filings(spark, d)
    return D.render_filing_docs(fil, F.lit(DAY1), short_form=F.dayofmonth("filing_date") == 13)


def _nameless(docs: DataFrame) -> DataFrame:
    """Filing documents with one more entry that has no accession number."""
    return docs.withColumn("doc", F.regexp_replace("doc", r'"(accessionNumber|form|filingDate)":\[', r'"$1":[null,'))


def _existing_filings(spark, d):
    return T.filings(spark, d).where(F.col("filing_date") < F.lit(CUTOFF))


@register("src_bronze_filings")
def _q(spark, d):
    rows = B.filing_rows(B.parse_filing_docs(_filing_docs(spark, d)))
    return rows.select("accession_number", "cik", "company_name", "form", "filing_date_str", "complete")


@register("silver_filings")
def _q(spark, d):
    """Documents with entries without accession number, loaded twice: nothing is inserted
    a second time."""
    silver = _existing_filings(spark, d)
    parsed = B.parse_filing_docs(_nameless(_filing_docs(spark, d)))
    once = silver.unionByName(SV.load_filings(parsed, silver).new_rows)
    return once.unionByName(SV.load_filings(parsed, once).new_rows)


@register("bronze_error_filings")
def _q(spark, d):
    """Companies whose fetch failed: their documents are reported under the company's id."""
    docs = D.render_filing_docs(T.filings(spark, d), F.lit(DAY1))
    failed = F.col(B.ENTITY).cast("bigint") % 7 == 0
    docs = docs.withColumn("doc", F.when(failed, F.lit("<html>429 Too Many Requests</html>")).otherwise(F.col("doc")))
    typed = SV.typing_filings(B.filing_rows(B.parse_filing_docs(docs), keep_empty=True))
    rejects = SV.load_typed_filings(typed, _existing_filings(spark, d)).rejects
    return rejects.groupBy("cik", "reject_reason").agg(F.count(F.lit(1)).alias("documents"))


@register("merge_new_filings")
def _q(spark, d):
    fil = T.filings(spark, d)
    revised = fil.withColumn("filing_type", F.lit("REVISED"))
    return M.merge_insert_if_absent(_existing_filings(spark, d), revised, S.FILINGS_KEY)


# companies

def _directory_entries(spark, d) -> DataFrame:
    c = T.table(spark, d, "customer")
    first = c.select((F.col("c_custkey") * 2).alias("order"), F.col("c_custkey").alias("cik_str"),
                     F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
                     F.col("c_name").alias("title"))
    # a second share class listed later for one nation's companies: last one wins
    second = c.where(F.col("c_nationkey") == 7).select(
        (F.col("c_custkey") * 2 + 1).alias("order"), F.col("c_custkey").alias("cik_str"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string"), F.lit("X")).alias("ticker"),
        F.col("c_name").alias("title"))
    return first.unionByName(second)


def _directory_rows(spark, d):
    docs = D.render_company_directory(_directory_entries(spark, d)).withColumn("ingest_date", F.lit(DAY2))
    return B.ticker_rows(B.parse_company_directory(docs))


def _old_directory_rows(spark, d):
    """The directory of the day before, other tickers, at later positions of later files."""
    old = _directory_entries(spark, d).select((F.col("order") + 10_000_000).alias("order"), "cik_str",
                                              F.lit("OLD").alias("ticker"), F.lit("Old Name").alias("title"))
    docs = D.render_company_directory(old).withColumn("ingest_date", F.lit(DAY1))
    return B.ticker_rows(B.parse_company_directory(docs))


@register("src_company_tickers")
def _q(spark, d):
    return _directory_rows(spark, d).select("cik", "ticker", "name")


@register("upsert_companies")
def _q(spark, d):
    c = T.table(spark, d, "customer")
    known = (T.companies(spark, d).join(c.select(F.col("c_custkey").cast("string").alias("cik"), "c_nationkey"), "cik")
             .where(F.col("c_nationkey") < 20)
             .select("cik", "ticker", F.upper("name").alias("name"), "is_active"))
    return SV.upsert_companies(known, _directory_rows(spark, d).unionByName(_old_directory_rows(spark, d)))


@register("upsert_series")
def _q(spark, d):
    """One series per part: known ones (even keys) are renamed, others are new; the later of
    two updates of a series wins."""
    part = T.table(spark, d, "part")
    sid = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    known = part.where("p_partkey % 2 = 0").select(sid.alias("series_id"), F.lit("old name").alias("name"),
                                                   F.lit("old").alias("category"), (F.col("p_partkey") % 3 == 0).alias("is_active"))
    first = part.select(sid.alias("series_id"), F.lit("first").alias("name"), F.lit("first").alias("category"), F.lit(1).alias("pos"))
    last = part.select(sid.alias("series_id"), "p_name", "p_brand", F.lit(2)).toDF("series_id", "name", "category", "pos")
    return SV.upsert_series(known, last.unionByName(first), order=["pos"])


@register("scan_active_companies")
def _q(spark, d):
    return R.filter_flag(T.companies(spark, d)).select("cik")


@register("scan_active_series")
def _q(spark, d):
    active = R.filter_flag(T.series(spark)).select("series_id")
    return T.observations(spark, d).join(active, "series_id", "left_semi")


@register("set_active_all")
def _q(spark, d):
    return M.set_flag(T.companies(spark, d), "is_active", False)


@register("set_active_where_in")
def _q(spark, d):
    c = M.set_flag(T.companies(spark, d), "is_active", False)
    return M.set_flag_where_in(c, "is_active", True, "ticker", IN_LIST_TICKERS)


NEW_COMPANY = ("9999999999", "NEWCO", "New Company Inc.")


@register("insert_config_row")
def _q(spark, d):
    row = literal_rows(spark, [NEW_COMPANY], "cik string, ticker string, name string")
    return SV.insert_config_rows(T.companies(spark, d), row, "companies")


def _with_violations(spark, d) -> dict[str, DataFrame]:
    """The four tables with a violation of each kind, at dates and keys that the data has."""
    o, f, c = T.observations(spark, d), T.filings(spark, d), T.companies(spark, d)
    day, order, n = F.dayofmonth("observation_date"), F.dayofmonth("filing_date"), F.col("cik").cast("bigint")
    series = T.table(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("series_id"),
                                              F.col("p_name").alias("name"), F.col("p_brand").alias("category"), F.lit(True).alias("is_active"))
    p = F.substring("series_id", 2, 20).cast("bigint")
    wide = lambda column, length: F.lpad(column, length, "0")
    return {
        "observations": o.withColumn("series_id", F.when(day == 1, F.lit(None)).when(day == 2, wide("series_id", 21)).otherwise(F.col("series_id")))
        .unionByName(o.where(day == 4)).withColumn("observation_date", F.when(day == 3, F.lit(None)).otherwise(F.col("observation_date"))),
        "filings": f.withColumns({
            "cik": F.when(order == 1, F.lit(None)).when(order == 2, wide("cik", 11)).otherwise(F.col("cik")),
            "filing_type": F.when(order == 3, wide("filing_type", 21)).otherwise(F.col("filing_type")),
            "company_name": F.when(order == 5, wide("company_name", 256)).otherwise(F.col("company_name")),
            "accession_number": F.when(order == 6, wide("accession_number", 26)).when(order == 7, F.lit(None)).otherwise(F.col("accession_number"))})
        .unionByName(f.where(order == 4)),
        "series": series.withColumns({
            "name": F.when(p % 7 == 1, F.lit(None)).when(p % 7 == 2, wide("name", 101)).otherwise(F.col("name")),
            "category": F.when(p % 7 == 3, F.lit(None)).when(p % 7 == 4, wide("category", 51)).otherwise(F.col("category")),
            "series_id": F.when(p % 7 == 5, F.lit(None)).when(p % 7 == 6, wide("series_id", 21)).otherwise(F.col("series_id"))})
        .unionByName(series.where(p % 7 == 0)),
        "companies": c.withColumns({
            "ticker": F.when(n % 7 == 1, F.lit(None)).when(n % 7 == 2, wide("ticker", 11)).otherwise(F.col("ticker")),
            "name": F.when(n % 7 == 3, F.lit(None)).when(n % 7 == 4, wide("name", 256)).otherwise(F.col("name")),
            "cik": F.when(n % 7 == 5, F.lit(None)).when(n % 7 == 6, wide("cik", 11)).otherwise(F.col("cik"))})
        .unionByName(c.where(n % 7 == 0)),
    }


@register("ddl_constraints")
def _q(spark, d):
    """Violations of every declared constraint of the four tables, one pass over each."""
    parts = [C.check(df, table).select(F.lit(table).alias("table_name"), "*") for table, df in _with_violations(spark, d).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- 2.K data quality -------------------------------------------------------


@register("run_suite")
def _q(spark, d):
    """The observation suite over the whole silver table (one pass)."""
    return Q.run_suite(T.observations(spark, d), Q.observation_suite())


@register("run_suite_samples")
def _q(spark, d):
    """The observation suite over rows with unexpected ids and keys that occur twice, with examples."""
    o = T.observations(spark, d)
    n, day = F.year("observation_date"), F.dayofmonth("observation_date")
    odd = F.when(day == 1, F.concat(F.lower("series_id"), F.lit("-"), n)).when(day == 2, F.lpad("series_id", 21, "X")).otherwise(F.col("series_id"))
    rows = o.withColumn("series_id", odd).unionByName(o.where((day == 3) & (F.col("series_id") == "DGS10")))
    found = Q.run_suite(rows, Q.observation_suite(), samples=20)
    return found.withColumn("unexpected_values", F.array_join("unexpected_values", " "))


@register("run_suite_bronze")
def _q(spark, d):
    """The same suite over the parsed bronze rows of the load (ids as delivered)."""
    rows = B.observation_rows(B.parse_observation_docs(_observation_docs(spark, d)))
    typed, _ = SV.typed_observations(rows)
    return Q.run_suite(typed.select("observation_date", "series_id", "value"), Q.observation_suite())


# --- 2.L arrival-driven load (Structured Streaming, availableNow) -----------


@register("stream_bronze_to_silver")
def _q(spark, d):
    """Half of the documents landed as single files (one day per year), half written by the
    engine, twice: the second write replaces the values of the first.  One stream loads both in
    several micro-batches into silver, read back."""
    base = scratch_path(spark, "stream-load")
    bronze, wh = f"{base}/bronze", Warehouse(f"{base}/warehouse")
    docs = _observation_docs(spark, d, revise=False)
    year = F.get_json_object("doc", "$.observations[0].date").substr(1, 4).cast("int")
    replaced = F.regexp_replace("doc", r'"value":"', '"value":"7')
    WR.write_bronze(docs.where(year % 2 == 0).withColumn("doc", replaced), bronze, "fred")
    WR.write_bronze(docs.where(year % 2 == 0), bronze, "fred")
    D.land_files(docs.where(year % 2 == 1).withColumn("ingest_date", F.date_add(F.lit(DAY1), year - 1990)), bronze, "fred")
    jobs.write_config(T.series(spark), wh.series)
    q = stream_bronze_to_silver(spark, bronze, wh, f"{base}/checkpoint", max_files=24)
    q.awaitTermination()
    return jobs.silver_observations(spark, wh).drop("ingested_at")


# --- 2.B views: the SQL path -------------------------------------------------


@register("ddl_views")
def _q(spark, d):
    """The daily snapshot through SQL over the registered views."""
    register_views(spark, T.observations(spark, d), T.filings(spark, d), T.companies(spark, d))
    return spark.sql("SELECT * FROM gold_daily_snapshot")


def _filled_warehouse(spark, d, name: str) -> Warehouse:
    """A warehouse whose silver tables hold the bound tables, with config."""
    wh = Warehouse(f"{scratch_path(spark, name)}/warehouse")
    obs, fil = jobs.create_tables(spark, wh)
    lay = layout(spark, wh.root)
    now = F.current_timestamp()
    append_bucketed(T.observations(spark, d).withColumn("ingested_at", now), obs, "series_id",
                    lay.observation_buckets, ["series_id", "observation_date"])
    append_bucketed(T.filings(spark, d).withColumn("ingested_at", now), fil, "accession_number",
                    lay.filing_buckets, ["accession_number"])
    jobs.write_config(T.series(spark), wh.series)
    jobs.write_config(T.companies(spark, d), wh.companies)
    return wh


@register("scan_silver")
def _q(spark, d):
    """The bucketed silver table, scanned whole."""
    return jobs.silver_observations(spark, _filled_warehouse(spark, d, "scan")).drop("ingested_at")


@register("ddl_tables")
def _q(spark, d):
    """Silver tables created, filled and read back by name."""
    wh = _filled_warehouse(spark, d, "ddl")
    obs, fil = jobs.create_tables(spark, wh)
    return spark.sql(f"""SELECT 'treasury_yields' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows,
                                CAST(COUNT(DISTINCT series_id) AS BIGINT) AS keys FROM {obs}
                         UNION ALL SELECT 'sec_filings', COUNT(*), COUNT(DISTINCT accession_number) FROM {fil}""")


def _refreshed_warehouse(spark, d, refresh=GS.refresh) -> Warehouse:
    """Silver filled by two loads that touch the same dates and companies, and refreshed after each."""
    wh = Warehouse(f"{scratch_path(spark, 'gold-store')}/warehouse")
    jobs.write_config(T.companies(spark, d), wh.companies)
    lay = layout(spark, wh.root)
    for half in (0, 1):
        obs, fil = jobs.create_tables(spark, wh)
        now = F.current_timestamp()
        o = T.observations(spark, d).where(F.pmod(F.crc32("series_id"), F.lit(2)) == half)
        f = T.filings(spark, d).where(F.pmod(F.crc32("accession_number"), F.lit(2)) == half)
        append_bucketed(o.withColumn("ingested_at", now), obs, "series_id", lay.observation_buckets, ["series_id", "observation_date"])
        append_bucketed(f.withColumn("ingested_at", now), fil, "accession_number", lay.filing_buckets, ["accession_number"])
        refresh(spark, wh)
    return wh


@register("refresh_validation")
def _q(spark, d):
    """The suite's results from the stored counts of the buckets, after two loads."""
    return VS.results(spark, _refreshed_warehouse(spark, d, VS.refresh))


for _dataset in GS.DATASETS:
    QUERIES["refresh_" + _dataset] = (lambda name: lambda spark, d: GS.dataset(spark, _refreshed_warehouse(spark, d), name))(_dataset)


#: views of a warehouse by their qualified names -> the columns compared
VIEWS = {
    "gold.yield_curve": "*", "gold.full_yield_curve": "*", "gold.credit_stress": "*", "gold.company_filings_summary": "*",
    "gold.daily_snapshot": "*", "gold.yield_curve_d10": "*", "staging.stg_treasury_yields": "*",
    "reference.fred_series": "series_id, name, category, is_active",
}
_VIEW_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def _view_warehouse(spark, d) -> Warehouse:
    """One warehouse for all view entries of an application and data folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _VIEW_WAREHOUSES:
        _VIEW_WAREHOUSES[key] = _filled_warehouse(spark, d, "views")
    return _VIEW_WAREHOUSES[key]


for _view, _columns in VIEWS.items():
    def _read_view(spark, d, view=_view, columns=_columns):
        register_warehouse(spark, _view_warehouse(spark, d))
        return spark.sql(f"SELECT {columns} FROM {view}")
    QUERIES["view_" + _view.split(".")[1]] = _read_view


@register("job_daily")
def _q(spark, d):
    """One daily run over bronze files: both sources, one result row each."""
    base = scratch_path(spark, "daily-job")
    bronze, wh = f"{base}/bronze", Warehouse(f"{base}/warehouse")
    WR.write_bronze(_observation_docs(spark, d, revise=False, ingest=DAY2), bronze, "fred")
    WR.write_bronze(D.render_filing_docs(T.filings(spark, d), F.lit(DAY2)), bronze, "sec")
    jobs.write_config(T.series(spark), wh.series)
    jobs.write_config(T.companies(spark, d), wh.companies)
    return jobs.run_daily(spark, bronze, wh, DAY2)


# --- sinks as round trips (write to the shared folder, read back) -----------

@register("sink_bronze")
def _q(spark, d):
    """Documents written as bronze and read back as observation rows.  One series is written
    a second time, spread over several lines; another entity's body is no JSON at all."""
    bronze = f"{scratch_path(spark, 'sink-bronze')}/bronze"
    docs = _observation_docs(spark, d)
    WR.write_bronze(docs.withColumn("doc", F.when(F.col(B.ENTITY) == "DGS10", F.lit('{"observations": []}'))
                                    .otherwise(F.col("doc"))), bronze, "fred")
    again = docs.where(F.col(B.ENTITY) == "DGS10")
    WR.write_bronze(again.withColumn("doc", F.regexp_replace("doc", r'([\[,{])', "$1\n  ")), bronze, "fred")
    page = again.limit(1).withColumn(B.ENTITY, F.lit("PAGE")).withColumn("doc", F.lit("<html>\n503\n</html>"))
    WR.write_bronze(page, bronze, "fred")
    return B.observation_rows(B.read_observation_docs(spark, bronze)).select("series_id", "date", "value")


@register("layout_by_key")
def _q(spark, d):
    """Observations written range-partitioned and sorted by key, read back with
    a series filter: files and row groups of other series are skipped."""
    path = f"{scratch_path(spark, 'layout')}/silver"
    WR.layout_by_key(T.observations(spark, d), ["series_id", "observation_date"]).write.parquet(path)
    return R.filter_series_eq(spark.read.schema(S.OBSERVATIONS).parquet(path), "DGS10")


@register("sink_validation_results")
def _q(spark, d):
    """Suite results appended to the results table and read back."""
    path = f"{scratch_path(spark, 'results')}/quality"
    WR.write_validation_results(Q.run_suite(T.observations(spark, d), Q.observation_suite()),
                                path, "fred_data_suite", "run-1")
    return spark.read.parquet(path).drop("validated_at", "suite", "run_id")


@register("quality_gate")
def _q(spark, d):
    """The gate over the silver table: passes, returning the results."""
    return Q.gate(Q.run_suite(T.observations(spark, d), Q.observation_suite()))


# --- the wide binding: one series per part key, so that it grows with the input ------------

WIDE = {
    "lag_change": W.lag_change, "running_total": W.running_total, "moving_avg_full": W.moving_avg_full,
    "moving_stddev": W.moving_stddev, "below_moving_avg": W.below_moving_avg, "quartile": W.quartile,
    "percent_rank": W.percent_rank, "second_highest": W.second_highest, "date_gaps": W.date_gaps,
    "year_over_year": W.year_over_year, "series_stats": A.series_stats, "pct_of_total": A.pct_of_total,
    "first_last": A.first_last, "rank_by_avg": A.rank_by_avg, "rollup": A.rollup, "cube": A.cube,
    "join_date_max": R.join_date_max, "above_global_avg": R.above_global_avg,
    "run_suite": lambda o: Q.run_suite(o, Q.observation_suite()),
}
for _name, _fn in WIDE.items():
    QUERIES[f"wide_{_name}"] = (lambda fn: lambda spark, d: fn(T.observations_wide(spark, d)))(_fn)


@register("wide_silver_observations")
def _q(spark, d):
    """The load's de-duplication and merge over one series per part: revised early values of
    known keys are ignored."""
    o = T.observations_wide(spark, d)
    docs = D.render_observation_docs(_raw_observation_strings(o), F.lit(DAY1))
    silver = o.where(F.col("observation_date") < F.lit(CUTOFF))
    return silver.unionByName(SV.load_observations(B.parse_observation_docs(docs), silver).new_rows)
