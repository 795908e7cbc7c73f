"""Vaccination-shaped raw tables derived from the driver's TPC-H-like tables.

One vaccination event per line item: order = patient, customer = patient
address, supplier = facility, part = vaccine, nation = city, region = state.
The same mapping exists as SQL text in ``__spark_entry__.oracle_sql`` for
the DuckDB oracle; both must produce identical values.

Scale: nation (25 rows) and region (5 rows) are fixed-size by the TPC-H
specification, so they are the only sides broadcast explicitly. The joins to
orders, customer, supplier and part are left to AQE, which broadcasts a side
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles both sides on the join key.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.schemas import RAW_VACCINATIONS
from vaxmart.session import table_path


# Plans built from the driver's tables, per session. The tables are
# read-only inputs, and a DataFrame is an immutable plan, so queries of one
# session can share them; this saves listing files, reading footers and
# re-analysing the nine-way mapping for every query.
_PLANS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def memo(spark: SparkSession, key: tuple, build):
    per_session = _PLANS.setdefault(spark, {})
    if key not in per_session:
        per_session[key] = build()
    return per_session[key]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = table_path(sf_dir, name)
    return memo(spark, ("table", path), lambda: spark.read.parquet(path))


def _s(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def _date_text(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load_table(spark, sf_dir, "nation")
    region = load_table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def _prefixed(places: DataFrame, prefix: str) -> DataFrame:
    return F.broadcast(
        places.select(
            F.col("n_nationkey").alias(f"{prefix}_nationkey"),
            F.col("n_name").alias(f"{prefix}_city"),
            F.col("r_name").alias(f"{prefix}_state"),
        )
    )


# --- fixed values: vaccine names and codes assigned to part types ----------
VACCINE_BY_PART_TYPE = [
    ("ECONOMY", "85", "Coronavac-Sinovac/Butantan"),
    ("LARGE", "86", "Vacina Covishield"),
    ("MEDIUM", "87", "Oxford/AstraZeneca"),
    ("PROMO", "88", "BioNTech/Pfizer"),
    ("SMALL", "89", "Janssen-Cilag"),
]
UNIDENTIFIED_VACCINE = ("99", "Pendente Identificação")  # p_size > 25
OTHER_VACCINE = ("90", "Outra")


def _by_part_type(index: int, fallback_big: str, fallback_small: str) -> Column:
    expr = None
    for p_type, code, name in VACCINE_BY_PART_TYPE:
        value = (code, name)[index]
        expr = F.when(F.col("p_type") == p_type, value) if expr is None else expr.when(F.col("p_type") == p_type, value)
    fallback = F.when(F.col("p_size") > 25, fallback_big).otherwise(fallback_small)
    return expr.otherwise(fallback)


def raw_vaccinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 38-column raw vaccination table, one row per line item."""
    return memo(spark, ("raw_vaccinations", sf_dir), lambda: _raw_vaccinations(spark, sf_dir))


def _raw_vaccinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load_table(spark, sf_dir, "lineitem")
    orders = load_table(spark, sf_dir, "orders")
    places = _nation_region(spark, sf_dir)
    customer = load_table(spark, sf_dir, "customer")
    supplier = load_table(spark, sf_dir, "supplier")
    part = load_table(spark, sf_dir, "part")

    # Orders meet customers first (an orders-sized shuffle on custkey), so
    # line items are shuffled on partkey, suppkey and orderkey only once each.
    # The sides that add least to a line come first, the widest (the patient)
    # last, and the names of places, by broadcast, after the last shuffle.
    patients = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(patients, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_prefixed(places, "cn"), F.col("c_nationkey") == F.col("cn_nationkey"))
        .join(_prefixed(places, "sn"), F.col("s_nationkey") == F.col("sn_nationkey"))
    )
    ship_date = _date_text("l_shipdate")
    order_date = _date_text("o_orderdate")
    key = F.col("l_orderkey")
    cols = {
        "document_id": F.concat_ws(
            "-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"), ship_date
        ),
        "paciente_id": _s("l_orderkey"),
        "paciente_idade": (key % 100).cast("int"),
        "paciente_dataNascimento": F.concat(_s(1920 + key % 100), F.lit("-01-01")),
        "paciente_enumSexoBiologico": F.when(key % 2 == 0, "F").otherwise("M"),
        "paciente_racaCor_codigo": F.substring("o_orderpriority", 1, 1),
        "paciente_racaCor_valor": F.substring("o_orderpriority", 3, 20),
        "paciente_endereco_coIbgeMunicipio": _s(120000 + F.col("c_nationkey")),
        "paciente_endereco_coPais": F.lit("10"),
        "paciente_endereco_nmMunicipio": F.col("cn_city"),
        "paciente_endereco_nmPais": F.lit("BRASIL"),
        "paciente_endereco_uf": F.col("cn_state"),
        "paciente_endereco_cep": F.lpad(_s("o_custkey"), 5, "0"),
        "paciente_nacionalidade_enumNacionalidade": F.when(key % 7 == 0, F.lit(None)).otherwise(F.lit("B")),
        "estabelecimento_valor": F.lpad(_s("l_suppkey"), 7, "0"),
        "estabelecimento_razaoSocial": F.col("s_name"),
        "estalecimento_noFantasia": F.concat(F.lit("Posto "), F.col("s_name")),
        "estabelecimento_municipio_codigo": _s(120000 + F.col("s_nationkey")),
        "estabelecimento_municipio_nome": F.col("sn_city"),
        "estabelecimento_uf": F.col("sn_state"),
        "vacina_grupoAtendimento_codigo": F.col("o_orderstatus"),
        "vacina_grupoAtendimento_nome": F.when(F.col("o_orderstatus") == "F", "Faixa Etaria").when(
            F.col("o_orderstatus") == "O", "Saude"
        ),
        "vacina_categoria_codigo": F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None)).otherwise(
            F.substring("c_mktsegment", 1, 2)
        ),
        "vacina_categoria_nome": F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")),
        "vacina_lote": F.col("p_brand"),
        "vacina_fabricante_nome": F.concat(F.lit("FAB "), F.col("p_type")),
        "vacina_fabricante_referencia": F.when(F.col("p_type") == "STANDARD", F.lit(None)).otherwise(
            F.concat(F.lit("Organization/"), F.col("p_type"))
        ),
        "vacina_dataAplicacao": F.concat(ship_date, F.lit("T00:00:00.000Z")),
        "vacina_descricao_dose": F.when(F.col("l_returnflag") == "A", "1ª Dose")
        .when(F.col("l_returnflag") == "N", "2ª Dose")
        .otherwise("Dose Única"),
        "vacina_codigo": _by_part_type(0, UNIDENTIFIED_VACCINE[0], OTHER_VACCINE[0]),
        "vacina_nome": _by_part_type(1, UNIDENTIFIED_VACCINE[1], OTHER_VACCINE[1]),
        "sistema_origem": F.lit("Novo PNI"),
        "id_sistema_origem": F.lit("16341"),
        "data_importacao_rnds": F.concat(order_date, F.lit("T12:34:56.000Z")),
        "redshift": F.lit("x"),
        "timestamp": F.concat(order_date, F.lit("T01:02:03.000Z")),
        "version": F.lit("1"),
        "year_month": F.concat(F.substring(ship_date, 1, 7), F.lit("-01")),
    }
    return joined.select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_VACCINATIONS.fields]
    )


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-column population table: one city per nation, state = region."""
    return memo(spark, ("raw_population", sf_dir), lambda: _raw_population(spark, sf_dir))


def _raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load_table(spark, sf_dir, "nation")
    region = load_table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("state"),
        (10 + F.col("n_regionkey")).cast("int").alias("state_ibge_code"),
        ((120000 + nk) * 10 + nk % 10).cast("int").alias("city_ibge_code"),
        F.col("n_name").alias("city"),
        (1000 * (nk + 1)).cast("int").alias("estimated_population"),
    )
