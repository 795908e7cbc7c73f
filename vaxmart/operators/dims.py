"""Dimension and fact builders of the star schema.

Each dimension collapses staging to one row per surrogate key with an
independent ``max`` per attribute (values may come from different rows;
nulls are ignored). ``max`` is combinable, so Spark aggregates partially on
the map side before the shuffle on the key: a key holding a third of all
rows (e.g. the hash of a blank id) reaches the reducer as one partial row
per map task, not as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.functions.keys import surrogate_key
from vaxmart.functions.temporal import calendar_fields
from vaxmart.schemas import FACILITY_ATTRIBUTES, FACT_COLUMNS, PATIENT_ATTRIBUTES, VACCINE_ATTRIBUTES
from vaxmart.sources.tables import one_line


def collapse_dimension(
    df: DataFrame, key: str, attributes: Sequence[str], casts: dict[str, str] | None = None, few_values: bool = False
) -> DataFrame:
    """One row per ``key``; every attribute is its own ``max`` over the group.

    Spark evaluates ``max`` of strings with a sort-based aggregate, still in
    two phases: a partial aggregate per map task, then the final one after
    the shuffle on ``key``. ``few_values`` is for dimensions with few
    different rows: those are counted first, by a hash aggregate, so only
    they are sorted; many texts are counted as one line. (A plain ``distinct`` would be removed by Catalyst below
    a duplicate-insensitive aggregate; the counts are used, to leave out
    groups without rows, which there are none of.)
    """
    casts = casts or {}
    if few_values:
        df = one_line(df.select(key, *attributes), [key], lambda rows: rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_rows")))
    aggs = []
    for a in attributes:
        agg = F.max(a)
        if a in casts:
            agg = agg.cast(casts[a])
        aggs.append(agg.alias(a))
    if few_values:
        return df.groupBy(key).agg(*aggs, F.sum("_rows").alias("_rows")).where("_rows > 0").drop("_rows")
    return df.groupBy(key).agg(*aggs)


def build_patients(staging: DataFrame) -> DataFrame:
    """Patients have a row a dose, mostly with the same attributes; those are counted first, so only different ones are sorted."""
    return collapse_dimension(staging, "patient_sk", PATIENT_ATTRIBUTES, casts={"patient_age": "int"}, few_values=True)


def build_facilities(staging: DataFrame, few_values: bool = False) -> DataFrame:
    return collapse_dimension(staging, "facility_sk", FACILITY_ATTRIBUTES, few_values=few_values)


def build_vaccines(staging: DataFrame, few_values: bool = False) -> DataFrame:
    return collapse_dimension(staging, "vaccine_sk", VACCINE_ATTRIBUTES, few_values=few_values)


def crop_city_code(col: str = "city_ibge_code", length: int = 6):
    """First ``length`` characters of the code's text (7-digit -> 6-digit code)."""
    return F.substring(F.col(col).cast("string"), 1, length)


def build_cities(population: DataFrame, code_length: int = 6) -> DataFrame:
    """dim_cities: population rows + a 6-character city code and its key.

    The vaccination side carries 6-digit city codes, the population side
    7-digit ones; the cropped code makes the two keys agree.
    """
    cropped = population.withColumn("cropped_city_ibge_code", crop_city_code("city_ibge_code", code_length))
    return cropped.select(surrogate_key("cropped_city_ibge_code").alias("city_sk"), "*")


def build_fact(staging: DataFrame) -> DataFrame:
    """fact_vaccinations: one row per staging row (no dedupe), count = 1."""
    return staging.select(*FACT_COLUMNS, F.lit(1).alias("vaccinations_count"))


def build_calendar(fact: DataFrame, date_col: str = "vaccination_date") -> DataFrame:
    """dim_calendar: the distinct dates present in the fact (not a continuous
    calendar), with day / ISO week / month / year / weekday (0 = Sunday).

    Distinct first (partial aggregation map-side), fields after: the
    expressions run once per date, not once per fact row.
    """
    dates = fact.select(F.col(date_col).alias("full_date")).distinct()
    fields = calendar_fields("full_date")
    return dates.select("full_date", *[c.alias(n) for n, c in fields.items()])
