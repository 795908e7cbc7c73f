"""End-to-end command line run and property checks against plain Python."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaxmart import cli
from vaxmart.functions import calendar_fields, weeks_between
from vaxmart.operators import merge
from vaxmart.sources.fixtures import raw_population, raw_vaccinations
from vaxmart.sources.tables import land_partitioned

from .conftest import SF_SMALL

dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=200))
def test_weeks_between_matches_python(spark, pairs):
    def monday(d):
        return d - dt.timedelta(days=d.weekday())

    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r.w for r in df.select(weeks_between("a", "b").alias("w")).collect()]
    assert got == [(monday(b) - monday(a)).days // 7 for a, b in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(dates, min_size=1, max_size=200))
def test_calendar_fields_match_python(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(*[c.alias(n) for n, c in calendar_fields("d").items()]).collect()
    want = [(d.day, d.isocalendar()[1], d.month, d.year, (d.weekday() + 1) % 7) for d in days]
    assert [tuple(r) for r in got] == want


@settings(max_examples=5, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 20), st.sampled_from(["a", "b"]), st.sampled_from(["m1", "m2"])), max_size=30),
    st.dictionaries(st.integers(0, 30), st.sampled_from(["x", "y"]), max_size=15),
    st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["z"])), max_size=5),
)
def test_merge_twice_equals_once_for_unique_batch_keys(spark, target_rows, batch_map, other_rows):
    target = spark.createDataFrame(target_rows, "pk int, v string, ym string")
    # keys unique within the loaded partition: merging twice changes nothing
    batch = spark.createDataFrame([(k, v, "m1") for k, v in batch_map.items()], "pk int, v string, ym string")
    once = merge.merge_partition(target, batch, "pk", "ym", "m1")
    twice = merge.merge_partition(once, batch, "pk", "ym", "m1")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # batch rows of another partition are inserted and nothing there is deleted
    other = spark.createDataFrame([(k, v, "m2") for k, v in other_rows], "pk int, v string, ym string")
    mixed = merge.merge_partition(target, batch.unionByName(other), "pk", "ym", "m1")
    kept = target.where(F.col("ym") != "m1").count()
    assert mixed.where(F.col("ym") != "m1").count() == kept + len(other_rows)


def test_cli_build_and_analyze(spark, workdir):
    landing, wh = f"{workdir}/landing", f"{workdir}/wh"
    land_partitioned(raw_vaccinations(spark, SF_SMALL), landing)
    raw_population(spark, SF_SMALL).write.option("header", True).csv(f"{workdir}/population")
    cli.main(["build", "--vaccinations", landing, "--population", f"{workdir}/population/*.csv",
              "--warehouse", wh, "--expected-states", "5"])
    assert spark.read.parquet(f"{wh}/fact_vaccinations").count() == 6000
    cli.main(["build", "--raw-table", f"{wh}/raw_vaccinations", "--population", f"{workdir}/population/*.csv",
              "--warehouse", f"{workdir}/pub", "--expected-states", "5", "--run-id", "day1"])
    cli.main(["analyze", "--warehouse", f"{workdir}/pub", "--published", "--analysis", "late_second_dose",
              "--as-of", "2001-11-05", "--out", f"{workdir}/r4"])
    got = {r.category: r.unique_patients_count for r in spark.read.parquet(f"{workdir}/r4").collect()}
    assert got == {"All patients": 756, "Already took 2 doses ": 236, "Late to take 2nd dose": 178}


def test_load_month_merges_one_partition(spark, workdir):
    from pyspark.sql import functions as F

    from vaxmart.plans import pipeline
    from vaxmart.schemas import RAW_VACCINATIONS

    landing, raw_path = f"{workdir}/landing", f"{workdir}/raw"
    raw = raw_vaccinations(spark, SF_SMALL)
    land_partitioned(raw, landing)
    months = sorted(r[0] for r in raw.select("year_month").distinct().collect())
    for ym in months[:2]:
        pipeline.load_month(spark, landing, raw_path, ym)
    # re-loading a month replaces its rows (same keys): still one copy each
    got = pipeline.load_month(spark, landing, raw_path, months[0])
    want = raw.where(F.col("year_month").isin(months[:2]))
    assert got.count() == want.count()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(*RAW_VACCINATIONS.names).collect()), key=str)
    cli.main(["load-month", "--landing", landing, "--raw", raw_path, "--year-month", months[2]])
    from pathlib import Path

    from vaxmart.session import checkpoint_dir, drop_scratch

    # parsed copies of the months go once they are merged
    assert not list(Path(checkpoint_dir(spark)).glob(f"batch-{months[2]}-*"))
    with pytest.raises(ValueError):
        drop_scratch(spark, raw_path)
    assert spark.read.parquet(raw_path).select("year_month").distinct().count() == 3


def test_cli_extract_lands_the_month_up_to_the_run_date(spark, workdir):
    from pyspark.sql import functions as F

    from vaxmart.schemas import RAW_VACCINATIONS
    from vaxmart.sources import csv as vcsv

    src = f"{workdir}/source"
    raw = raw_vaccinations(spark, SF_SMALL)
    raw.write.parquet(src)
    landing, bm = f"{workdir}/landing", f"{workdir}/bm"
    cli.main(["extract", "--source", src, "--landing", landing, "--bookmarks", bm, "--until", "1998-06-15"])
    day = F.col("vacina_dataAplicacao").cast("date")
    want = raw.where((day >= F.lit("1998-06-01").cast("date")) & (day <= F.lit("1998-06-15").cast("date")))
    got = vcsv.load_csv(spark, vcsv.landing_glob(landing), RAW_VACCINATIONS)
    assert sorted(r.document_id for r in got.collect()) == sorted(r.document_id for r in want.collect())


def test_cli_ingest_streams_the_landing_files(spark, workdir):
    raw = raw_vaccinations(spark, SF_SMALL).where("year_month = '1998-06-01'")
    landing, target = f"{workdir}/landing", f"{workdir}/raw"
    land_partitioned(raw, landing)
    for _ in range(2):
        cli.main(["ingest", "--landing", landing, "--target", target, "--checkpoint", f"{workdir}/ckpt"])
        assert spark.read.parquet(target).count() == raw.count() > 0


def test_load_month_keeps_rejects_beside_the_raw_table(spark, workdir):
    import os

    from vaxmart.plans import pipeline
    from vaxmart.schemas import RAW_VACCINATIONS
    from vaxmart.sources import csv as vcsv
    from vaxmart.sources.tables import is_empty

    raw = raw_vaccinations(spark, SF_SMALL).where("year_month = '1998-06-01'")
    landing, raw_path = f"{workdir}/landing", f"{workdir}/raw"
    land_partitioned(raw, landing)
    folder = f"{landing}/year_month=1998-06-01/estabelecimento_uf=XX"
    os.makedirs(folder)
    with open(f"{folder}/stray.csv", "w") as f:
        f.write("header\nonly,two\n")
    with pytest.raises(vcsv.RejectBudgetExceeded):
        pipeline.load_month(spark, landing, raw_path, "1998-06-01")
    assert is_empty(spark, raw_path, RAW_VACCINATIONS)
    assert pipeline.load_month(spark, landing, raw_path, "1998-06-01", max_errors=2).count() == raw.count()
    assert [r.record.strip() for r in vcsv.read_rejects(spark, raw_path).collect()] == ["only,two"]
