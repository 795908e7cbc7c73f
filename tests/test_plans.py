"""Analyses and the load pipeline on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from vaxmart.operators import quality
from vaxmart.plans import analytics, pipeline
from vaxmart.plans.catalog import AS_OF
from vaxmart.plans.star import star_from_fixtures
from vaxmart.sources import fixtures

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    return star_from_fixtures(spark, SF_SMALL)


def test_expected_fixture_counts(star):
    assert star.staging.count() == 6000
    assert star.patients.count() == 1473
    assert star.facilities.count() == 10
    assert star.vaccines.count() == 336
    assert star.cities.count() == 25
    assert star.calendar.count() == 2289


def test_late_second_dose_figures_and_textbook_form(star):
    got = {r.category: (r.unique_patients_count, r.pct_of_total)
           for r in analytics.late_second_dose(star.fact, star.vaccines, as_of=AS_OF).collect()}
    assert got == {"All patients": (756, 100.0), "Already took 2 doses ": (236, 31.22),
                   "Late to take 2nd dose": (178, 23.54)}
    textbook = analytics.anti_join_late(star.fact, star.vaccines, as_of=AS_OF)
    assert textbook.count() == got["Late to take 2nd dose"][0]


def test_weekly_sum_equals_filtered_fact_count(star):
    weekly = analytics.weekly_by_type(star.fact, star.calendar, star.vaccines)
    total = weekly.agg(F.sum("total_vaccinations")).first()[0]
    named = star.vaccines.where(F.col("vaccine_type_name") != "Pendente Identificação").select("vaccine_sk")
    expected = star.fact.where(F.col("vaccination_date").isNotNull()).join(named, "vaccine_sk").count()
    assert total == expected


def test_last_running_total_is_state_total(star):
    r1 = analytics.cumulative_per_capita(star.fact, star.calendar, star.facilities, star.cities)
    last = {r.state: r.c for r in r1.groupBy("state").agg(F.max("cumulative_daily_vaccinations").alias("c")).collect()}
    totals = {r.state: float(r.n) for r in r1.groupBy("state").agg(F.sum("daily_vaccinations").alias("n")).collect()}
    assert last == totals


def test_dimension_rows_equal_distinct_keys(star):
    for dim, key in ((star.patients, "patient_sk"), (star.facilities, "facility_sk"), (star.vaccines, "vaccine_sk")):
        assert dim.count() == star.staging.select(key).distinct().count()


def test_pipeline_builds_checks_and_reports(spark, workdir):
    raw = fixtures.raw_vaccinations(spark, SF_SMALL)
    pop = fixtures.raw_population(spark, SF_SMALL)
    rows = pipeline.run(spark, raw, pop, workdir, expected_states=5)
    assert len(rows) == 5 and all(r.passed for r in rows)
    wh = pipeline.Warehouse(workdir)
    assert spark.read.parquet(wh.path("fact_vaccinations")).count() == 6000
    staged = spark.read.parquet(wh.path("staging_vaccinations"))
    assert staged.count() == 6000 and len(staged.columns) == 43
    assert spark.read.parquet(wh.path("dim_calendar")).count() == 2289
    # the warehouse expects 6 states; the fixture has 5 -> the report fails
    with pytest.raises(quality.DataQualityError):
        quality.assert_report(pipeline.default_checks(spark, wh, expected_states=6))


def test_pipeline_quarantines_bad_casts(spark, workdir):
    from pyspark.sql import functions as F

    raw = fixtures.raw_vaccinations(spark, SF_SMALL)
    broken = raw.withColumn(
        "vacina_codigo", F.when(F.col("document_id").startswith("1-"), F.lit("x")).otherwise(F.col("vacina_codigo"))
    )
    n_bad = raw.where(F.col("document_id").startswith("1-")).count()
    pop = fixtures.raw_population(spark, SF_SMALL)
    with pytest.raises(Exception):
        pipeline.run(spark, broken, pop, f"{workdir}/strict", expected_states=5)
    pipeline.run(spark, broken, pop, f"{workdir}/q", expected_states=5, quarantine=True)
    wh = pipeline.Warehouse(f"{workdir}/q")
    rejects = spark.read.parquet(wh.path("staging_rejects"))
    assert rejects.count() == n_bad > 0
    assert {r[0] for r in rejects.select("_reject_reason").distinct().collect()} == {"vacina_codigo"}
    assert spark.read.parquet(wh.path("fact_vaccinations")).count() == 6000 - n_bad


def test_publish_only_after_checks(spark, workdir):
    raw = fixtures.raw_vaccinations(spark, SF_SMALL)
    pop = fixtures.raw_population(spark, SF_SMALL)
    pipeline.run_and_publish(spark, raw, pop, workdir, "r1", expected_states=5)
    first = pipeline.current_warehouse(spark, workdir)
    assert first.root.endswith("runs/r1")
    assert spark.read.parquet(first.path("fact_vaccinations")).count() == 6000
    with pytest.raises(quality.DataQualityError):  # the fixture has 5 states, not 6
        pipeline.run_and_publish(spark, raw, pop, workdir, "r2", expected_states=6)
    assert pipeline.current_warehouse(spark, workdir).root == first.root


def test_negative_check_lineitem_key_is_not_unique(spark):
    from vaxmart.plans.catalog import QUERIES

    row = QUERIES["dq_unique_lineitem_fails"](spark, SF_SMALL).first()
    assert (row.observed, row.expected, row.passed) == (1161, 0, False)
    with pytest.raises(quality.DataQualityError):
        quality.assert_report(QUERIES["dq_unique_lineitem_fails"](spark, SF_SMALL))
