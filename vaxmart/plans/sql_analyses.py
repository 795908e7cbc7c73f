"""The four analyses as SQL text over table names; ``{db}`` is the database that holds the star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vaxmart.functions.categories import VACCINE_TYPE_RULES
from vaxmart.plans.analytics import FIRST_DOSE, LATE_CATEGORIES, UNIDENTIFIED_VACCINE_NAME


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def normalized(column: str, rules: Sequence[tuple[str, Sequence[str]]] = VACCINE_TYPE_RULES) -> str:
    """The category rules as a searched CASE."""
    hits = (" OR ".join(f"contains(lower({column}), {_text(n)})" for n in needles) for _, needles in rules)
    return "CASE " + " ".join(f"WHEN {hit} THEN {_text(label)}" for hit, (label, _) in zip(hits, rules)) + f" ELSE {column} END"


_STATE_DAYS = """
per_facility AS (
  SELECT vaccination_date, facility_sk, sum(vaccinations_count) AS doses FROM {db}.fact_vaccinations GROUP BY ALL
), people AS (
  SELECT state, sum(estimated_population) AS state_population FROM {db}.dim_cities GROUP BY state
), state_days AS (
  SELECT c.full_date AS vaccination_date, p.state, max(p.state_population) AS state_population, sum(d.doses) AS doses
  FROM per_facility d
  JOIN {db}.dim_calendar c ON c.full_date = d.vaccination_date
  JOIN {db}.dim_facilities f ON f.facility_sk = d.facility_sk
  JOIN people p ON p.state = f.facility_state_abbrev
  GROUP BY c.full_date, p.state
)"""

CUMULATIVE_PER_CAPITA = f"""
WITH {_STATE_DAYS}
SELECT *, try_divide(cumulative_daily_vaccinations, state_population) AS cumulative_daily_vaccinations_per_capta
FROM (
  SELECT vaccination_date, state, state_population, doses AS daily_vaccinations,
         CAST(sum(doses) OVER (PARTITION BY state ORDER BY vaccination_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_daily_vaccinations
  FROM state_days
)"""

DAILY_PER_CAPITA = f"""
WITH {_STATE_DAYS}, rates AS (
  SELECT vaccination_date, state, try_divide(CAST(doses AS DOUBLE), state_population) AS vaccinations_per_capta FROM state_days
)
SELECT vaccination_date, state, vaccinations_per_capta,
       round(avg(vaccinations_per_capta) OVER (PARTITION BY state ORDER BY vaccination_date ROWS 29 PRECEDING), 10) AS rolling_avg_30_days
FROM rates"""

WEEKLY_BY_TYPE = f"""
WITH per_vaccine AS (
  SELECT vaccination_date, vaccine_sk, sum(vaccinations_count) AS doses FROM {{db}}.fact_vaccinations GROUP BY ALL
)
SELECT CAST(date_trunc('week', c.full_date) AS DATE) AS period, {normalized('v.vaccine_type_name')} AS vaccine_type, sum(d.doses) AS total_vaccinations
FROM per_vaccine d
JOIN {{db}}.dim_calendar c ON c.full_date = d.vaccination_date
JOIN {{db}}.dim_vaccines v ON v.vaccine_sk = d.vaccine_sk
WHERE v.vaccine_type_name <> {_text(UNIDENTIFIED_VACCINE_NAME)}
GROUP BY 1, 2"""

LATE_SECOND_DOSE = f"""
WITH per_patient AS (
  SELECT f.patient_sk, count(*) AS n,
         bool_or(v.vaccination_dose_description = {_text(FIRST_DOSE)}
                 AND datediff(date_trunc('week', DATE '{{as_of}}'), date_trunc('week', f.vaccination_date)) >= 35) AS overdue
  FROM {{db}}.fact_vaccinations f JOIN {{db}}.dim_vaccines v ON v.vaccine_sk = f.vaccine_sk
  WHERE {normalized('v.vaccine_type_name')} = 'Coronavac'
  GROUP BY f.patient_sk
), totals AS (
  SELECT count(*) AS everyone, count_if(n > 1) AS twice, count_if(n = 1 AND overdue) AS late FROM per_patient
), stacked AS (
  SELECT greatest(everyone, twice, late) AS most,
         stack(3, {_text(LATE_CATEGORIES[0])}, everyone, {_text(LATE_CATEGORIES[1])}, twice, {_text(LATE_CATEGORIES[2])}, late)
           AS (category, unique_patients_count)
  FROM totals
)
SELECT category, unique_patients_count, round(100 * try_divide(CAST(unique_patients_count AS DOUBLE), CAST(most AS DOUBLE)), 2) AS pct_of_total
FROM stacked ORDER BY category"""


def run(spark: SparkSession, text: str, database: str, as_of: dt.date | None = None) -> DataFrame:
    return spark.sql(text.format(db=f"`{database}`", as_of=as_of or dt.date.today()))
