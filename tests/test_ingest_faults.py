"""Inputs that must not lose or change data: stray quotes, odd values, null partitions, repeated and replaced runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaxmart.operators import dims, quality
from vaxmart.operators.ingest import extract_to_landing
from vaxmart.schemas import RAW_VACCINATIONS
from vaxmart.sources import csv as vcsv
from vaxmart.sources.tables import land_partitioned, write_layout

from .test_io import _raw, raw_row

SCHEMA = "id int, name string, n int"


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _file(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return str(path)


def test_stray_quote_spends_the_budget_by_lines(spark, tmp_path):
    lines = ["id,name,n"] + [f'{i},{chr(34) if i == 5 else ""}x,{i}' for i in range(1000)]
    path = _file(tmp_path / "a.csv", lines)
    for check in ("during", "before"):
        with pytest.raises(vcsv.RejectBudgetExceeded):
            vcsv.load_csv_to_table(spark, path, _schema(spark), str(tmp_path / check), max_errors=100, budget_check=check)


def test_rejects_are_kept(spark, tmp_path):
    path = _file(tmp_path / "a.csv", ["id,name,n", "1,a,1", "x,b,2", "3,c", "4,d,4"])
    table = vcsv.load_csv_to_table(spark, path, _schema(spark), str(tmp_path / "t"), max_errors=5)
    assert sorted(r.id for r in table.collect()) == [1, 4]
    kept = vcsv.read_rejects(spark, str(tmp_path / "t")).collect()
    assert sorted(r.record.strip() for r in kept) == ["3,c", "x,b,2"] and all(r.lines == 1 and r.file.endswith("a.csv") for r in kept)


def test_read_partition_allows_no_malformed_row(spark, tmp_path):
    (tmp_path / "p=1").mkdir()
    _file(tmp_path / "p=1" / "a.csv", ["id,name,n", "1,a,1", "x,b,2"])
    with pytest.raises(vcsv.RejectBudgetExceeded):
        vcsv.read_partition(spark, str(tmp_path), "p", "1", _schema(spark), sub_partitions=[])


@pytest.mark.parametrize("value", [" lead", "trail ", "\ttab\t", " ", 'quo"te', "a,b", "line\nbreak", "back\\slash", "é", None])
def test_landing_keeps_values(spark, tmp_path, value):
    rows = _raw(spark, [raw_row(document_id="a", vacina_lote=value)])
    land_partitioned(rows, str(tmp_path / "l"))
    got = vcsv.load_csv(spark, vcsv.landing_glob(str(tmp_path / "l")), RAW_VACCINATIONS).first()
    assert got.vacina_lote == value


def test_empty_text_reads_back_as_null(spark, tmp_path):
    land_partitioned(_raw(spark, [raw_row(document_id="a", vacina_lote="")]), str(tmp_path / "l"))
    assert vcsv.load_csv(spark, vcsv.landing_glob(str(tmp_path / "l")), RAW_VACCINATIONS).first().vacina_lote is None


def _landed(spark, base):
    return sorted(r.document_id for r in vcsv.load_csv(spark, vcsv.landing_glob(base), RAW_VACCINATIONS).collect())


def _day(n):
    return f"2021-07-{n:02d}T00:00:00.000Z"


def test_run_repeated_after_a_crash_lands_once(spark, tmp_path, monkeypatch):
    from vaxmart.operators import ingest

    base, bookmarks = str(tmp_path / "l"), str(tmp_path / "b")
    source = _raw(spark, [raw_row(document_id="a", vacina_dataAplicacao=_day(3)), raw_row(document_id="b", vacina_dataAplicacao=_day(9))])

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "next_bookmarks", crash)
        with pytest.raises(RuntimeError):
            extract_to_landing(spark, source, base, bookmarks, dt.date(2021, 7, 10))
    assert _landed(spark, base) == ["a", "b"]
    for _ in range(2):
        extract_to_landing(spark, source, base, bookmarks, dt.date(2021, 7, 10))
        assert _landed(spark, base) == ["a", "b"]


def test_month_end_replaces_its_month_only(spark, tmp_path):
    base, bookmarks = str(tmp_path / "l"), str(tmp_path / "b")
    june = _raw(spark, [raw_row(document_id="j", vacina_dataAplicacao="2021-06-30T00:00:00.000Z", year_month="2021-06-01")])
    extract_to_landing(spark, june, base, bookmarks, dt.date(2021, 6, 30))
    first = _raw(spark, [raw_row(document_id="a", vacina_dataAplicacao=_day(3), estabelecimento_uf="RS"),
                         raw_row(document_id="b", vacina_dataAplicacao=_day(3), estabelecimento_uf="SC")])
    extract_to_landing(spark, first, base, bookmarks, dt.date(2021, 7, 10))
    # The month-end source has no RS rows, and a July row that names June.
    last = _raw(spark, [raw_row(document_id="b", vacina_dataAplicacao=_day(3), estabelecimento_uf="SC"),
                        raw_row(document_id="m", vacina_dataAplicacao=_day(20), estabelecimento_uf="SC", year_month="2021-06-01")])
    extract_to_landing(spark, last, base, bookmarks, dt.date(2021, 7, 31))
    assert _landed(spark, base) == ["b", "j", "m"]
    only = _raw(spark, [raw_row(document_id="z", vacina_dataAplicacao=_day(20), estabelecimento_uf="PR")])
    extract_to_landing(spark, only, base, bookmarks, dt.date(2021, 7, 31), states=["PR", "AC"])
    assert _landed(spark, base) == ["b", "j", "m", "z"]


def test_fact_layout_splits_a_hot_patient(spark):
    n = 6000
    rows = spark.range(n).select(
        F.lit("2021-07-01").alias("vaccination_date"), F.md5(F.col("id").cast("string")).alias("vaccination_sk"),
        F.when(F.col("id") % 3 == 0, F.md5(F.lit(""))).otherwise(F.md5(F.col("id").cast("string"))).alias("patient_sk"))
    out = write_layout(rows, range_by=["vaccination_date", "vaccination_sk"], num_partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8


def test_small_dimensions_are_counted_before_they_are_sorted(spark):
    staging = spark.createDataFrame([("k", "a", "b")] * 3 + [("k", "c", None), ("l", None, None)], "sk string, x string, y string")
    built = dims.collapse_dimension(staging, "sk", ["x", "y"], few_values=True)
    assert sorted(map(tuple, built.collect()), key=str) == [("k", "c", "b"), ("l", None, None)]
    plan = built._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortAggregate") < plan.index("HashAggregate")


def test_contract_report_compares_types(spark):
    rows = _raw(spark, [raw_row(document_id="a")]).withColumn("paciente_idade", F.col("paciente_idade").cast("string"))
    bad = {r["column_name"] for r in quality.contract_report(rows).where("NOT passed").collect()}
    assert "paciente_idade" in bad and "paciente_id" not in bad
