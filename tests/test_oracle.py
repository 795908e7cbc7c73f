"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

from tools.compare import duck, normalise

from .conftest import SF_SMALL

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from vaxmart.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got_arrow = queries()[name](spark, SF_SMALL).toArrow()
    want_arrow = con.sql(oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got_arrow.schema} == {f.name: str(f.type) for f in want_arrow.schema}
    got = got_arrow.to_pandas(date_as_object=True)
    want = want_arrow.to_pandas(date_as_object=True)
    assert len(got) == len(want)
    assert normalise(got) == normalise(want)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["period", "vaccine_type", "total_vaccinations"]
    assert df.count() > 0
