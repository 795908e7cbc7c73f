"""Physical-plan properties the design relies on at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from vaxmart.operators.joins import anti_join_not_in
from vaxmart.operators.windows import percent_of_max
from vaxmart.plans import analytics
from vaxmart.plans.catalog import AS_OF
from vaxmart.plans.star import star_from_fixtures
from vaxmart.sources.fixtures import load_table

from .conftest import SF_SMALL


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def written_star(spark, tmp_path_factory):
    """The star as written tables, like the analyses read it in production."""
    root = str(tmp_path_factory.mktemp("wh"))
    s = star_from_fixtures(spark, SF_SMALL)
    for name in ("fact", "calendar", "facilities", "cities", "vaccines"):
        getattr(s, name).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in
            ("fact", "calendar", "facilities", "cities", "vaccines")}


def test_late_second_dose_is_one_patient_shuffle(written_star):
    s = written_star
    p = plan(analytics.late_second_dose(s["fact"], s["vaccines"], as_of=AS_OF))
    assert "Window" not in p
    assert "NestedLoopJoin" not in p
    # one hash exchange keyed on patient_sk; the per-patient aggregate is partial first
    assert len(re.findall(r"Exchange hashpartitioning\(patient_sk", p)) == 1
    assert "partial_count" in p


def test_fact_is_aggregated_before_dimension_joins(written_star):
    s = written_star
    p = plan(analytics.weekly_by_type(s["fact"], s["calendar"], s["vaccines"]))
    # the fact scan feeds a partial aggregate directly, before any join
    fact_scan = [line for line in p.splitlines() if "FileScan parquet" in line and "/fact" in line]
    assert fact_scan and "ReadSchema: struct<vaccine_sk:string,vaccination_date:date,vaccinations_count:int>" in fact_scan[0]
    lines = p.splitlines()
    idx = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "/fact" in line)
    above = "\n".join(lines[max(0, idx - 3):idx])
    assert "partial_sum" in above


def test_percent_of_max_uses_a_scalar_subquery(spark):
    orders = load_table(spark, SF_SMALL, "orders")
    df = percent_of_max(orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), "n", "p")
    p = plan(df)
    assert "Subquery" in p
    assert "Window" not in p and "CartesianProduct" not in p and "NestedLoopJoin" not in p
    df.collect()
    assert "ReusedExchange" in plan(df)  # the input's shuffle is computed once for both


def test_not_in_is_not_a_null_aware_broadcast(spark):
    customer = load_table(spark, SF_SMALL, "customer")
    orders = load_table(spark, SF_SMALL, "orders")
    p = plan(anti_join_not_in(customer, orders, "c_custkey", "o_custkey"))
    assert "LeftAnti" in p
    assert "NestedLoopJoin" not in p
    assert not re.search(r"LeftAnti.*true", p)  # Spark's null-aware anti join flag


def test_filters_and_columns_reach_the_scan(spark):
    orders = load_table(spark, SF_SMALL, "orders")
    p = plan(orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in p


def test_dimension_collapse_is_partial_then_final(spark):
    from vaxmart.operators.dims import build_vaccines

    st = spark.createDataFrame([("k", "d", 1, "n", "b", "m", "r")],
                               "vaccine_sk string, vaccination_dose_description string, vaccine_type_code int, "
                               "vaccine_type_name string, vaccine_batch_code string, vaccine_manufacturer_name string, "
                               "vaccine_manufacturer_reference_code string")
    p = plan(build_vaccines(st))
    assert "partial_max" in p  # map-side combine before the shuffle
    assert len(re.findall(r"Exchange hashpartitioning\(vaccine_sk", p)) == 1


def test_incremental_extract_pushes_the_time_window_to_the_scan(spark):
    from vaxmart.plans.catalog import QUERIES

    p = plan(QUERIES["incremental_extract"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in p
    assert "LessThan(ts,2024-01-26T00:00)" in p


def test_merge_reads_only_the_loaded_partition(spark, tmp_path):
    from vaxmart.operators.merge import merge_rows

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "pk int, v string, ym string") \
        .write.partitionBy("ym").parquet(path)
    target = spark.read.parquet(path)
    batch = spark.createDataFrame([(1, "z", "m1")], "pk int, v string, ym string")
    p = plan(merge_rows(target.where(F.col("ym") == "m1"), batch, "pk"))
    assert "PartitionFilters: [isnotnull(ym" in p and "(ym" in p and "= m1)" in p


def test_lines_cross_their_shuffles_without_names_of_places(spark):
    from vaxmart.sources.fixtures import raw_vaccinations

    p = plan(raw_vaccinations(spark, SF_SMALL))
    # Joins from the last (top) to the first: the places, the patient, the supplier, the vaccine.
    at = [p.index(f"{k}#") for k in ("[s_nationkey", "[c_nationkey", "Join [l_orderkey", "Join [l_suppkey", "Join [l_partkey")]
    assert at == sorted(at)


def test_patients_are_counted_by_hash_before_they_are_sorted(spark):
    from vaxmart.operators.dims import build_patients

    p = plan(build_patients(star_from_fixtures(spark, SF_SMALL).staging))
    counted = [line for line in p.splitlines() if "HashAggregate(keys=[patient_sk" in line]
    assert len(counted) == 2 and "_line" in counted[0]
