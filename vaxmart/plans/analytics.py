"""The four analyses over the star schema.

Plan shape shared by all of them: the fact (the only large input) is first
aggregated to one row per (date, dimension key) with a map-side partial
aggregate, and only then joined to the dimensions. Every dimension join is
on the dimension's unique key, so aggregating first gives the same sums
while the joins and the final grouping see days x keys rows instead of
events. Catalyst does not push aggregates below joins by itself, so this is
written out here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.functions.categories import VACCINE_TYPE_RULES, normalize_category
from vaxmart.functions.temporal import week_start, weeks_between
from vaxmart.operators.windows import moving_average, running_total

# --- fixed values: labels and filters of the analyses ----------------------
UNIDENTIFIED_VACCINE_NAME = "Pendente Identificação"
FIRST_DOSE = "1ª Dose"
LATE_CATEGORIES = ("All patients", "Already took 2 doses ", "Late to take 2nd dose")


def state_populations(cities: DataFrame) -> DataFrame:
    """Population summed per state before any join, so city rows don't multiply facts."""
    return cities.groupBy("state").agg(F.sum("estimated_population").alias("state_population"))


def _daily_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy("vaccination_date", key).agg(F.sum("vaccinations_count").alias("_n"))


def _daily_state_base(fact: DataFrame, calendar: DataFrame, facilities: DataFrame, cities: DataFrame) -> DataFrame:
    """(date, facility) partial counts joined to calendar, facility state and state population."""
    daily = _daily_by(fact, "facility_sk")
    cal = calendar.select(F.col("full_date"))
    fac = facilities.select("facility_sk", F.col("facility_state_abbrev").alias("state"))
    return (
        daily.join(cal, daily.vaccination_date == cal.full_date)
        .join(fac, "facility_sk")
        .join(state_populations(cities), "state")
        .select(F.col("full_date").alias("vaccination_date"), "state", "state_population", "_n")
    )


def cumulative_per_capita(fact: DataFrame, calendar: DataFrame, facilities: DataFrame, cities: DataFrame) -> DataFrame:
    """R1: daily vaccinations per facility state, running total and running total per capita."""
    daily = (
        _daily_state_base(fact, calendar, facilities, cities)
        .groupBy("vaccination_date", "state")
        .agg(F.max("state_population").alias("state_population"), F.sum("_n").alias("daily_vaccinations"))
    )
    cumulative = running_total(
        daily, ["state"], "vaccination_date", "daily_vaccinations", "cumulative_daily_vaccinations", as_double=True
    )
    return cumulative.withColumn(
        "cumulative_daily_vaccinations_per_capta",
        F.try_divide(F.col("cumulative_daily_vaccinations"), F.col("state_population")),
    )


def daily_per_capita_moving_avg(
    fact: DataFrame,
    calendar: DataFrame,
    facilities: DataFrame,
    cities: DataFrame,
    n_rows: int = 30,
    round_digits: int | None = None,
) -> DataFrame:
    """R2: daily vaccinations per capita and its average over the last ``n_rows`` rows (not days)."""
    daily = (
        _daily_state_base(fact, calendar, facilities, cities)
        .groupBy("vaccination_date", "state")
        .agg(
            F.try_divide(F.sum("_n").cast("double"), F.max("state_population")).alias("vaccinations_per_capta")
        )
    )
    return moving_average(
        daily,
        ["state"],
        "vaccination_date",
        "vaccinations_per_capta",
        f"rolling_avg_{n_rows}_days",
        n_rows=n_rows,
        round_digits=round_digits,
    )


def weekly_by_type(
    fact: DataFrame,
    calendar: DataFrame,
    vaccines: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] = VACCINE_TYPE_RULES,
    exclude_name: str = UNIDENTIFIED_VACCINE_NAME,
) -> DataFrame:
    """R3: vaccinations per Monday-starting week and normalised vaccine type."""
    daily = _daily_by(fact, "vaccine_sk")
    cal = calendar.select("full_date")
    vac = vaccines.where(F.col("vaccine_type_name") != exclude_name).select(
        "vaccine_sk", normalize_category("vaccine_type_name", rules).alias("vaccine_type")
    )
    return (
        daily.join(cal, daily.vaccination_date == cal.full_date)
        .join(vac, "vaccine_sk")
        .groupBy(week_start("full_date").alias("period"), "vaccine_type")
        .agg(F.sum("_n").alias("total_vaccinations"))
    )


def late_second_dose(
    fact: DataFrame,
    vaccines: DataFrame,
    as_of: dt.date | str | None = None,
    vaccine_type: str = "Coronavac",
    first_dose: str = FIRST_DOSE,
    min_weeks: int = 5,
    rules: Sequence[tuple[str, Sequence[str]]] = VACCINE_TYPE_RULES,
    categories: Sequence[str] = LATE_CATEGORIES,
) -> DataFrame:
    """R4: patients of one vaccine type — all / more than one row / late for dose 2.

    "Late" = a first-dose row at least ``min_weeks`` week boundaries before
    ``as_of``, for a patient who does not have more than one row. Computed in
    one shuffle: per patient, the row count and whether any row is a late
    first dose; then three conditional counts. A patient is in the "two
    doses" set iff the row count is > 1, so "late and not in two doses" is
    exactly "row count = 1 and that row is late" — the NOT IN anti join of the
    textbook form (``anti_join_late``) is not needed. The 3-row summary comes
    from one aggregate row via ``stack``; its percentages use
    ``greatest`` of the three counts, i.e. ``max(n) over ()``.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    vac = (
        vaccines.withColumn("_type", normalize_category("vaccine_type_name", rules))
        .where(F.col("_type") == vaccine_type)
        .select("vaccine_sk", "vaccination_dose_description")
    )
    rows = fact.join(vac, "vaccine_sk").select(
        "patient_sk",
        (
            (weeks_between("vaccination_date", today) >= min_weeks)
            & (F.col("vaccination_dose_description") == first_dose)
        ).alias("_late_first"),
    )
    per_patient = rows.groupBy("patient_sk").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_late_first").alias("_late")
    )
    summary = per_patient.agg(
        F.count(F.lit(1)).alias("_all"),
        F.count_if(F.col("_rows") > 1).alias("_two"),
        F.count_if((F.col("_rows") == 1) & F.col("_late")).alias("_lt"),
    ).withColumn("_peak", F.greatest("_all", "_two", "_lt").cast("double"))
    c_all, c_two, c_late = categories
    stacked = summary.select(
        "_peak",
        F.stack(
            F.lit(3), F.lit(c_all), "_all", F.lit(c_two), "_two", F.lit(c_late), "_lt"
        ).alias("category", "unique_patients_count"),
    )
    pct = F.round(100 * F.try_divide(F.col("unique_patients_count").cast("double"), F.col("_peak")), 2)
    return stacked.select("category", "unique_patients_count", pct.alias("pct_of_total")).orderBy("category")


def anti_join_late(
    fact: DataFrame,
    vaccines: DataFrame,
    as_of: dt.date | str | None = None,
    vaccine_type: str = "Coronavac",
    first_dose: str = FIRST_DOSE,
    min_weeks: int = 5,
    rules: Sequence[tuple[str, Sequence[str]]] = VACCINE_TYPE_RULES,
) -> DataFrame:
    """Textbook form of R4's third set: late first-dose rows whose patient is
    NOT IN the "more than one row" set, as a left anti join (the key is an
    MD5 and never null, so it equals NOT IN). Returns the distinct patients."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    vac = (
        vaccines.withColumn("_type", normalize_category("vaccine_type_name", rules))
        .where(F.col("_type") == vaccine_type)
        .select("vaccine_sk", "vaccination_dose_description")
    )
    rows = fact.join(vac, "vaccine_sk")
    two = rows.groupBy("patient_sk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("patient_sk")
    late = rows.where(
        (weeks_between("vaccination_date", today) >= min_weeks) & (F.col("vaccination_dose_description") == first_dose)
    )
    return late.join(two, "patient_sk", "left_anti").select("patient_sk").distinct()
