"""The star schema as lazy DataFrames: staging -> 5 dimensions + 1 fact.

Each table is built on first access only, so a query that needs the fact
and one dimension does not construct (and analyse) the others.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vaxmart.operators import dims
from vaxmart.operators.staging import build_staging
from vaxmart.sources import fixtures


class Star:
    def __init__(self, raw_vaccinations: DataFrame, raw_population: DataFrame, strict: bool = True):
        self.raw_vaccinations = raw_vaccinations
        self.raw_population = raw_population
        self.strict = strict

    @cached_property
    def staging(self) -> DataFrame:
        return build_staging(self.raw_vaccinations, strict=self.strict)

    @cached_property
    def fact(self) -> DataFrame:
        return dims.build_fact(self.staging)

    @cached_property
    def patients(self) -> DataFrame:
        return dims.build_patients(self.staging)

    @cached_property
    def facilities(self) -> DataFrame:
        return dims.build_facilities(self.staging, few_values=True)

    @cached_property
    def vaccines(self) -> DataFrame:
        return dims.build_vaccines(self.staging, few_values=True)

    @cached_property
    def cities(self) -> DataFrame:
        return dims.build_cities(self.raw_population)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.build_calendar(self.fact)


def build_star(raw_vaccinations: DataFrame, raw_population: DataFrame, strict: bool = True) -> Star:
    return Star(raw_vaccinations, raw_population, strict=strict)


def star_from_fixtures(spark: SparkSession, sf_dir: str) -> Star:
    """The star over the driver's tables; one (lazy) instance per session and directory."""
    return fixtures.memo(
        spark,
        ("star", sf_dir),
        lambda: build_star(fixtures.raw_vaccinations(spark, sf_dir), fixtures.raw_population(spark, sf_dir)),
    )
