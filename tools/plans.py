"""Write PLANS.md: executed physical plans of the analyses and main operators.

Builds the warehouse once (sf dir given, default sf0.01) with the pipeline,
then runs each plan on the written tables (the production path) and records
the final adaptive plan tree.
Usage: python tools/plans.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from vaxmart.operators import dims, ingest, merge, quality  # noqa: E402
from vaxmart.plans import analytics, pipeline  # noqa: E402
from vaxmart.plans.catalog import AS_OF  # noqa: E402
from vaxmart.session import build_session, scratch_path  # noqa: E402
from vaxmart.sources import fixtures  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    text = out.getvalue()
    tree = text.split("\n\n\n")[0]
    tree = re.sub(r"#\d+L?", "", tree)
    return tree.strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "plans-warehouse")
    pipeline.run(spark, fixtures.raw_vaccinations(spark, sf_dir), fixtures.raw_population(spark, sf_dir), root,
                 expected_states=5)
    wh = pipeline.Warehouse(root)
    t = {n: spark.read.parquet(wh.path(n)) for n in ("staging_vaccinations", "fact_vaccinations", "dim_calendar",
                                                      "dim_facilities", "dim_cities", "dim_vaccines", "dim_patients")}
    stg, fact, cal, fac, cit, vac, pat = (t[n] for n in t)
    orders = fixtures.load_table(spark, sf_dir, "orders").withColumn(
        "year_month", F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd"))
    batch = orders.where(F.col("year_month") == "1998-06-01").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    events = fixtures.load_table(spark, sf_dir, "events")
    bm = ingest.next_bookmarks(ingest.incremental_extract(events, "2024-01-14", None, "event_type", "ts"),
                               None, "event_type", "ts")
    plans = {
        "R1 cumulative_per_capita": analytics.cumulative_per_capita(fact, cal, fac, cit),
        "R2 daily_per_capita_moving_avg": analytics.daily_per_capita_moving_avg(fact, cal, fac, cit),
        "R3 weekly_by_type": analytics.weekly_by_type(fact, cal, vac),
        "R4 late_second_dose": analytics.late_second_dose(fact, vac, as_of=AS_OF),
        "dim_patients (from staging)": dims.build_patients(stg),
        "dim_calendar (from fact)": dims.build_calendar(fact),
        "check_unique(fact, vaccination_sk)": quality.check_unique(fact, "vaccination_sk"),
        "check_distinct_count(states through fact)": quality.check_distinct_count(
            fact, fac, "facility_sk", "facility_state_abbrev", 6),
        "merge_partition (orders, one month)": merge.merge_partition(orders, batch, "o_orderkey", "year_month",
                                                                     "1998-06-01"),
        "incremental_extract (events by bookmark)": ingest.incremental_extract(
            events, "2024-01-25", bm, "event_type", "ts"),
    }
    parts = ["# Physical plans\n",
             f"Final adaptive plans on `{sf_dir}` after the pipeline wrote the star "
             "(generated by `tools/plans.py`; expression ids removed).\n"]
    for title, df in plans.items():
        parts.append(f"## {title}\n\n```\n{final_plan(df)}\n```\n")
    with open(out_file, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
