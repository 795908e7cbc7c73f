"""Command line: load landing files, build the star, run the analyses.

    python -m vaxmart.cli extract --source <table> --landing <landing dir> --bookmarks <dir> --until 2021-07-19
    python -m vaxmart.cli load-month --landing <landing dir> --raw <raw table> --year-month 2021-07-01
    python -m vaxmart.cli build --raw-table <raw table> --population <csv glob> --warehouse <dir>
    python -m vaxmart.cli build --vaccinations <landing dir> --population <csv glob> --warehouse <dir>
    python -m vaxmart.cli analyze --warehouse <dir> --analysis late_second_dose --as-of 2021-07-19 --out <dir>
    python -m vaxmart.cli ingest --landing <dir> --target <dir> --checkpoint <dir>

Runs on whatever master ``spark-submit`` provides (``--master`` for local use).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from vaxmart.operators.quality import conform_to_contract
from vaxmart.plans import analytics, pipeline
from vaxmart.schemas import RAW_POPULATION, RAW_VACCINATIONS
from vaxmart.session import build_session
from vaxmart.sources import csv as vcsv
from vaxmart.streaming.merge_stream import MAX_FILES, stream_merge

ANALYSES = ("cumulative_per_capita", "daily_per_capita_moving_avg", "weekly_by_type", "late_second_dose")


def _session(args):
    if args.master:
        return build_session(args.master)
    from pyspark.sql import SparkSession

    from vaxmart.session import apply_required_conf

    spark = SparkSession.builder.appName("vaxmart").getOrCreate()
    apply_required_conf(spark)
    return spark


def cmd_extract(args) -> None:
    from vaxmart.operators.ingest import extract_to_landing

    spark = _session(args)
    if args.source_format == "csv":
        source = vcsv.load_csv(spark, args.source, RAW_VACCINATIONS, max_errors=args.max_errors)
    else:
        source = conform_to_contract(spark.read.parquet(args.source))
    states = args.states.split(",") if args.states else None
    mode = extract_to_landing(spark, source, args.landing, args.bookmarks, dt.date.fromisoformat(args.until),
                              states=states)
    print(json.dumps({"until": args.until, "mode": mode}))


def cmd_load_month(args) -> None:
    spark = _session(args)
    raw = pipeline.load_month(spark, args.landing, args.raw, args.year_month, max_errors=args.max_errors)
    print(json.dumps({"raw_table": args.raw, "year_month": args.year_month}))
    del raw


def cmd_build(args) -> None:
    spark = _session(args)
    wh = pipeline.Warehouse(args.warehouse)
    if args.raw_table:
        raw = conform_to_contract(spark.read.parquet(args.raw_table))
    else:
        raw = vcsv.load_csv_to_table(
            spark, vcsv.landing_glob(args.vaccinations), RAW_VACCINATIONS, wh.path("raw_vaccinations"),
            max_errors=args.max_errors, budget_check=args.budget_check, partition_by=["year_month"],
            multi_line=not args.single_line,
        )
    pop = vcsv.load_csv_to_table(
        spark, args.population, RAW_POPULATION, wh.path("raw_population"), max_errors=0,
        budget_check=args.budget_check,
    )
    if args.run_id:
        rows = pipeline.run_and_publish(spark, raw, pop, args.warehouse, args.run_id,
                                        expected_states=args.expected_states, quarantine=args.quarantine,
                                        normalized_type=args.normalized_type)
    else:
        rows = pipeline.run(spark, raw, pop, args.warehouse, expected_states=args.expected_states,
                            raise_on_failure=not args.no_raise, quarantine=args.quarantine,
                            normalized_type=args.normalized_type)
    print(json.dumps([r.asDict() for r in rows]))


def cmd_analyze(args) -> None:
    spark = _session(args)
    wh = pipeline.current_warehouse(spark, args.warehouse) if args.published else pipeline.Warehouse(args.warehouse)
    t = {n: spark.read.parquet(wh.path(n)) for n in
         ("fact_vaccinations", "dim_calendar", "dim_facilities", "dim_cities", "dim_vaccines")}
    fact, cal, fac, cit, vac = (t[n] for n in
                                ("fact_vaccinations", "dim_calendar", "dim_facilities", "dim_cities", "dim_vaccines"))
    if args.analysis == "cumulative_per_capita":
        df = analytics.cumulative_per_capita(fact, cal, fac, cit)
    elif args.analysis == "daily_per_capita_moving_avg":
        df = analytics.daily_per_capita_moving_avg(fact, cal, fac, cit, n_rows=args.window_rows)
    elif args.analysis == "weekly_by_type":
        df = analytics.weekly_by_type(fact, cal, vac)
    else:
        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
        df = analytics.late_second_dose(fact, vac, as_of=as_of, vaccine_type=args.vaccine_type)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        shown = df.cache()
        shown.show(args.show, truncate=False)
        more = shown.count() - args.show
        if more > 0:
            print(f"{more} more rows are not shown; --out writes them all")


def cmd_ingest(args) -> None:
    spark = _session(args)
    query = stream_merge(spark, args.landing, args.target, args.checkpoint,
                         max_files_per_trigger=args.max_files_per_trigger, max_errors=args.max_errors)
    query.awaitTermination()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="vaxmart")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: the spark-submit master")
    sub = p.add_subparsers(dest="command", required=True)

    e = sub.add_parser("extract", help="daily run: rows after each state's bookmark -> landing files -> bookmarks")
    e.add_argument("--source", required=True, help="source table path (raw vaccination columns)")
    e.add_argument("--source-format", choices=("parquet", "csv"), default="parquet")
    e.add_argument("--landing", required=True)
    e.add_argument("--bookmarks", required=True, help="bookmark table path")
    e.add_argument("--until", required=True, help="run date; the month's last day reloads the month")
    e.add_argument("--states", default=None, help="comma separated, e.g. AC,MA,PE,PR,RS,SC")
    e.add_argument("--max-errors", type=int, default=0)
    e.set_defaults(fn=cmd_extract)

    m = sub.add_parser("load-month", help="merge one month of landing files into the raw table")
    m.add_argument("--landing", required=True, help="landing root (year_month=*/estabelecimento_uf=*/)")
    m.add_argument("--raw", required=True, help="raw table path (partitioned by year_month)")
    m.add_argument("--year-month", required=True, help="e.g. 2021-07-01")
    m.add_argument("--max-errors", type=int, default=0)
    m.set_defaults(fn=cmd_load_month)

    b = sub.add_parser("build", help="load landing CSV (or use a raw table), build the star; run checks")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--vaccinations", help="landing root: full reload of all landing files")
    src.add_argument("--raw-table", help="an existing raw table (e.g. kept current with load-month)")
    b.add_argument("--population", required=True, help="population CSV path or glob")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--max-errors", type=int, default=100)
    b.add_argument("--budget-check", choices=("during", "before"), default="before")
    b.add_argument("--expected-states", type=int, default=6)
    b.add_argument("--no-raise", action="store_true", help="report failed checks without failing")
    b.add_argument("--run-id", default=None,
                   help="build into <warehouse>/runs/<id> and publish it only if every check passes")
    b.add_argument("--quarantine", action="store_true",
                   help="write rows whose values do not cast to staging_rejects instead of failing")
    b.add_argument("--normalized-type", action="store_true", help="stage the normalised vaccine type, too")
    b.add_argument("--single-line", action="store_true",
                   help="no field holds a line break: large plain CSV files can be split")
    b.set_defaults(fn=cmd_build)

    a = sub.add_parser("analyze", help="run one analysis on a built warehouse")
    a.add_argument("--warehouse", required=True)
    a.add_argument("--analysis", choices=ANALYSES, required=True)
    a.add_argument("--published", action="store_true", help="use the latest published run under --warehouse")
    a.add_argument("--as-of", default=None, help="'today' of late_second_dose (default: current date)")
    a.add_argument("--vaccine-type", default="Coronavac")
    a.add_argument("--window-rows", type=int, default=30)
    a.add_argument("--out", default=None, help="write the result as parquet here instead of showing it")
    a.add_argument("--show", type=int, default=50)
    a.set_defaults(fn=cmd_analyze)

    i = sub.add_parser("ingest", help="merge new landing files into a partitioned table (availableNow)")
    i.add_argument("--landing", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES)
    i.add_argument("--max-errors", type=int, default=0, help="rejected lines allowed in a batch")
    i.set_defaults(fn=cmd_ingest)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
