"""Staging, dimensions, windows, quality checks, joins on hand-made rows."""

import datetime as dt

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from vaxmart.operators import dims, quality
from vaxmart.operators.joins import anti_join_not_in
from vaxmart.operators.staging import build_staging, cast_rejects, rename_and_cast
from vaxmart.operators.windows import moving_average, percent_of_max, running_total
from vaxmart.schemas import RAW_VACCINATIONS

EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def raw_row(**overrides):
    base = {f.name: None for f in RAW_VACCINATIONS.fields}
    base.update(
        document_id="doc1", paciente_id="p1", paciente_idade=30, estabelecimento_valor="0000012",
        estabelecimento_municipio_codigo="120001", vacina_dataAplicacao="2021-07-01T00:00:00.000Z",
        vacina_codigo="85", vacina_lote="L1", vacina_descricao_dose="1ª Dose",
        paciente_endereco_coIbgeMunicipio="120001", data_importacao_rnds="2021-07-02T12:00:00.000Z",
        timestamp="2021-07-02T01:02:03.000Z", year_month="2021-07-01",
    )
    base.update(overrides)
    return tuple(base[f.name] for f in RAW_VACCINATIONS.fields)


def test_staging_keys_and_types(spark):
    raw = spark.createDataFrame([raw_row()], RAW_VACCINATIONS)
    st = build_staging(raw)
    assert st.columns[:5] == ["vaccination_sk", "patient_sk", "facility_sk", "vaccine_sk", "city_sk"]
    assert len(st.columns) == 43
    r = st.first()
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert r.vaccination_sk == md5("doc1p12021-07-01")
    assert r.facility_sk == md5("12")  # after the int cast: leading zeros gone
    assert r.vaccine_sk == md5("85L11ª Dose")
    assert r.city_sk == md5("120001")
    assert r.vaccination_date == dt.date(2021, 7, 1)
    assert r.elasticsearch_timestamp == dt.datetime(2021, 7, 2, 1, 2, 3)
    assert dict(st.dtypes)["elasticsearch_timestamp"] == "timestamp_ntz"


def test_staging_null_hash_inputs(spark):
    raw = spark.createDataFrame(
        [raw_row(document_id=None, paciente_id=None, vacina_dataAplicacao=None, estabelecimento_valor=None,
                 vacina_codigo=None, vacina_lote=None, vacina_descricao_dose=None,
                 paciente_endereco_coIbgeMunicipio=None)],
        RAW_VACCINATIONS,
    )
    r = build_staging(raw).first()
    assert {r.vaccination_sk, r.patient_sk, r.facility_sk, r.vaccine_sk, r.city_sk} == {EMPTY_MD5}


def test_strict_cast_raises_and_quarantine(spark):
    raw = spark.createDataFrame(
        [raw_row(), raw_row(document_id="d2", estabelecimento_valor="abc"),
         raw_row(document_id="d3", vacina_dataAplicacao="2021-13-01"), raw_row(document_id="d4", vacina_codigo="")],
        RAW_VACCINATIONS,
    )
    with pytest.raises((NumberFormatException, SparkRuntimeException, ArithmeticException, Exception)):
        rename_and_cast(raw).collect()
    lenient = rename_and_cast(raw, strict=False).collect()
    assert lenient[1].facility_code is None
    rejects = {r.document_id: r._reject_reason for r in cast_rejects(raw).collect()}
    assert rejects == {"d2": "estabelecimento_valor", "d3": "vacina_dataAplicacao", "d4": "vacina_codigo"}


def test_collapse_dimension_independent_max(spark):
    df = spark.createDataFrame(
        [("k", "b", 1, None), ("k", "a", 2, "x"), ("j", None, None, None)], "k string, s string, n int, z string"
    )
    out = {r.k: r for r in dims.collapse_dimension(df, "k", ["s", "n", "z"]).collect()}
    assert (out["k"].s, out["k"].n, out["k"].z) == ("b", 2, "x")  # values from different rows
    assert (out["j"].s, out["j"].n) == (None, None)


def test_calendar_keeps_one_null_date(spark):
    fact = spark.createDataFrame(
        [(dt.date(2021, 1, 3),), (dt.date(2021, 1, 3),), (None,)], "vaccination_date date"
    )
    cal = dims.build_calendar(fact).collect()
    assert len(cal) == 2
    assert sorted([r.full_date for r in cal], key=lambda d: (d is None, d))[-1] is None


def test_running_total_and_moving_average_rows_not_days(spark):
    rows = [("s", dt.date(2021, 1, d), v) for d, v in [(1, 1), (2, 2), (5, 3), (6, 4)]]
    df = spark.createDataFrame(rows, "g string, d date, v long")
    rt = [r.t for r in running_total(df, ["g"], "d", "v", "t").orderBy("d").collect()]
    assert rt == [1, 3, 6, 10]
    ma = [r.m for r in moving_average(df, ["g"], "d", "v", "m", n_rows=2).orderBy("d").collect()]
    assert ma == [1.0, 1.5, 2.5, 3.5]  # gap between day 2 and day 5 is not filled


def test_percent_of_max(spark):
    df = spark.createDataFrame([("a", 200), ("b", 57), ("c", 0)], "k string, n long")
    got = {r.k: r.p for r in percent_of_max(df, "n", "p").collect()}
    assert got == {"a": 100.0, "b": 28.5, "c": 0.0}


def test_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right_empty = spark.createDataFrame([], "k int")
    right = spark.createDataFrame([(2,)], "k int")
    right_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert sorted(r.k for r in anti_join_not_in(left, right, "k", "k").collect()) == [1]
    assert anti_join_not_in(left, right_null, "k", "k").count() == 0
    assert anti_join_not_in(left, right_empty, "k", "k").count() == 3  # NOT IN () keeps nulls
    assert anti_join_not_in(left, right_null, "k", "k", null_aware=False).count() == 2


def test_quality_checks_and_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (EMPTY_MD5,)], "k string")
    rep = {r.check: r for r in quality.run_checks([
        quality.check_unique(df, "k", "u"),
        quality.check_not_null(df, "k", "nn"),
        quality.check_no_blank_key(df, "k", "blank"),
    ]).collect()}
    assert (rep["u"].observed, rep["u"].passed) == (1, False)
    assert (rep["nn"].observed, rep["nn"].passed) == (1, False)
    assert rep["blank"].observed == 1
    with pytest.raises(quality.DataQualityError):
        quality.assert_report(quality.check_unique(df, "k"))
    assert quality.check_scalar(df.agg(F.count(F.lit(1))), 5) == 5
    with pytest.raises(quality.DataQualityError):
        quality.check_scalar(df.agg(F.count(F.lit(1))), 6)


def test_duplicate_groups_prehash_is_exact(spark, monkeypatch):
    rows = [("a", 1), ("a", 1), ("b", 1), ("c", 2), (None, 1), (None, 1), ("c", 2), ("c", 2)]
    df = spark.createDataFrame(rows, "k string, j int")
    direct = sorted(map(tuple, quality.duplicate_groups(df, ["k", "j"], prehash=False).collect()), key=str)
    hashed = sorted(map(tuple, quality.duplicate_groups(df, ["k", "j"], prehash=True).collect()), key=str)
    assert direct == hashed == sorted([("a", 1, 2), ("c", 2, 3), (None, 1, 2)], key=str)
    # every key colliding (a constant "hash") still gives the exact answer
    monkeypatch.setattr(quality.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    many = spark.range(50).select(F.col("id").cast("string").alias("k"))
    dup = many.unionByName(many.where(F.col("k").isin("1", "2", "3")))
    assert sorted(r.k for r in quality.duplicate_groups(dup, ["k"]).collect()) == ["1", "2", "3"]


def test_distinct_through_join_counts_null_once(spark):
    fact = spark.createDataFrame([("f1",), ("f1",), ("f2",), ("f3",)], "facility_sk string")
    dim = spark.createDataFrame([("f1", "SC"), ("f2", None), ("f3", None)], "facility_sk string, st string")
    assert quality.distinct_through_join(fact, dim, "facility_sk", "st").count() == 2


def test_contract_report_flags_nulls_missing_and_extra(spark):
    raw = spark.createDataFrame([raw_row(), raw_row(paciente_id=None)], RAW_VACCINATIONS)
    raw = raw.drop("version").withColumn("extra", F.lit(1))
    rep = {r.column_name: r for r in quality.contract_report(raw).collect()}
    assert rep["paciente_id"].null_count == 1 and not rep["paciente_id"].passed
    assert rep["paciente_nacionalidade_enumNacionalidade"].passed  # nullable by contract
    assert not rep["version"].present and not rep["version"].passed
    assert rep["extra"].declared_type is None and not rep["extra"].passed
    assert rep["document_id"].passed


def test_conform_to_contract(spark):
    raw = spark.createDataFrame([raw_row()], RAW_VACCINATIONS).withColumn("extra", F.lit(1))
    shuffled = raw.select("extra", *reversed(RAW_VACCINATIONS.names))
    assert quality.conform_to_contract(shuffled).columns == RAW_VACCINATIONS.names
    with pytest.raises(quality.DataQualityError):
        quality.conform_to_contract(raw.drop("version"))
    with pytest.raises(quality.DataQualityError):
        quality.conform_to_contract(raw.withColumn("paciente_idade", F.col("paciente_idade").cast("string")))
