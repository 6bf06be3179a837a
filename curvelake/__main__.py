"""Command line for cluster runs (``spark-submit -m curvelake …`` or
``python -m curvelake …``); the master and resources come from spark-submit.

    daily     --bronze B --warehouse W --date 2026-01-28
    backfill  --bronze B --warehouse W --start 2026-01-01 --end 2026-01-28
    validate  --warehouse W [--run-id ID] [--table filings] [--new]   (raises when the suite fails; --new
                                                   reads only the buckets that gained rows)
    stream    --bronze B --warehouse W --checkpoint C [--continuous]
    gold      --warehouse W --out O                (writes the five gold datasets)
    refresh   --warehouse W [--out O]              (brings stored gold up to what silver gained; writes the datasets)
    compact   --warehouse W                        (one file per bucket again; no load may run)
    sql       --warehouse W "SELECT * FROM gold.daily_snapshot"
    config    --warehouse W seed                   (the tracked series; known ones keep their state)
    config    --warehouse W companies --directory company_tickers.json
    config    --warehouse W activate|deactivate --table series|companies [--ids A,B]
    config    --warehouse W add --table companies --row 320193,AAPL,"Apple Inc."
    config    --warehouse W list --table series

Global sizing: ``--input-tb 100 --executors 1000 --cores 8`` applies
``session.scale_conf`` (scan split size, shuffle partitions, skew thresholds).
"""

from __future__ import annotations

import argparse
import csv
import datetime as dt
import uuid

from curvelake import jobs
from curvelake.operators import gold
from curvelake.session import get_spark, scale_conf


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="curvelake")
    ap.add_argument("--input-tb", type=float, default=None,
                    help="size the session for this input volume (with --executors/--cores)")
    ap.add_argument("--executors", type=int, default=None)
    ap.add_argument("--cores", type=int, default=None, help="cores per executor")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("daily", "backfill", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--bronze", required=True)
        p.add_argument("--warehouse", required=True)
        p.add_argument("--gate-before-append", action="store_true",
                       help="run the quality suite on each batch and stop before appending")
    sub.choices["daily"].add_argument("--date", type=_date, default=dt.date.today())
    sub.choices["backfill"].add_argument("--start", type=_date, required=True)
    sub.choices["backfill"].add_argument("--end", type=_date, required=True)
    sub.choices["stream"].add_argument("--checkpoint", required=True)
    sub.choices["stream"].add_argument("--continuous", action="store_true")
    sub.choices["stream"].add_argument("--max-files", type=int, default=None,
                                       help="bound each micro-batch to this many new files")
    v = sub.add_parser("validate")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--run-id", default=None)
    v.add_argument("--table", choices=["observations", "filings"], default="observations")
    v.add_argument("--new", action="store_true")
    g = sub.add_parser("gold")
    g.add_argument("--warehouse", required=True)
    g.add_argument("--out", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--out", default=None)
    sub.add_parser("compact").add_argument("--warehouse", required=True)
    q = sub.add_parser("sql")
    q.add_argument("--warehouse", required=True)
    q.add_argument("query")
    c = sub.add_parser("config")
    c.add_argument("--warehouse", required=True)
    c.add_argument("action", choices=["seed", "companies", "activate", "deactivate", "add", "list"])
    c.add_argument("--table", choices=["series", "companies"], default="series")
    c.add_argument("--directory", help="company directory file or folder")
    c.add_argument("--ids", help="comma-separated series ids or tickers (default: all rows)")
    c.add_argument("--row", help="the new row's values, comma-separated")
    a = ap.parse_args(argv)

    extra = None
    if a.input_tb and a.executors and a.cores:
        extra = scale_conf(int(a.input_tb * 1024 ** 4), a.executors, a.cores)
    spark = get_spark(extra=extra)
    wh = jobs.Warehouse(a.warehouse)
    if a.cmd == "daily":
        jobs.run_daily(spark, a.bronze, wh, a.date, a.gate_before_append).show(truncate=False)
    elif a.cmd == "backfill":
        jobs.backfill(spark, a.bronze, wh, a.start, a.end, a.gate_before_append).show(truncate=False)
    elif a.cmd == "validate":
        from curvelake.sinks import validation_store

        res = (validation_store.validate_new(spark, wh, a.table) if a.new
               else jobs.validate(spark, wh, a.run_id or uuid.uuid4().hex, a.table))
        res.show(truncate=False)
    elif a.cmd == "stream":
        from curvelake.streaming.bronze_stream import stream_bronze_to_silver

        stream_bronze_to_silver(spark, a.bronze, wh, a.checkpoint, available_now=not a.continuous,
                                max_files=a.max_files,
                                gate_before_append=a.gate_before_append).awaitTermination()
    elif a.cmd == "gold":
        obs = jobs.silver_observations(spark, wh).drop("ingested_at")
        fil = jobs.silver_filings(spark, wh).drop("ingested_at")
        comp = jobs.companies_config(spark, wh)
        for name, df in {"yield_curve": gold.yield_curve(obs), "full_yield_curve": gold.full_yield_curve(obs),
                         "credit_stress": gold.credit_stress(obs), "daily_snapshot": gold.daily_snapshot(obs),
                         "company_filings_summary": gold.filings_summary(fil, comp)}.items():
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
    elif a.cmd == "refresh":
        from curvelake.sinks import gold_store

        gold_store.refresh(spark, wh)
        for name in gold_store.DATASETS if a.out else ():
            gold_store.dataset(spark, wh, name).write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
    elif a.cmd == "compact":
        jobs.compact(spark, wh)
    elif a.cmd == "sql":
        from curvelake.plans.views import register_warehouse

        register_warehouse(spark, wh)
        spark.sql(a.query).show(truncate=False)
    elif a.cmd == "config":
        jobs.change_config(spark, wh, a.action, a.table, a.directory, a.ids.split(",") if a.ids else None,
                           next(csv.reader([a.row])) if a.row else None).show(1000, truncate=False)


if __name__ == "__main__":
    main()
