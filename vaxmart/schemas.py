"""Fixed schemas, rename/cast map and dimension attribute lists.

All names below are fixed values: they must equal the source system's
column names and the warehouse model's names for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw vaccination columns, in file (positional) order ----
RAW_VACCINATION_COLUMNS = [
    "document_id",
    "paciente_id",
    "paciente_idade",
    "paciente_dataNascimento",
    "paciente_enumSexoBiologico",
    "paciente_racaCor_codigo",
    "paciente_racaCor_valor",
    "paciente_endereco_coIbgeMunicipio",
    "paciente_endereco_coPais",
    "paciente_endereco_nmMunicipio",
    "paciente_endereco_nmPais",
    "paciente_endereco_uf",
    "paciente_endereco_cep",
    "paciente_nacionalidade_enumNacionalidade",
    "estabelecimento_valor",
    "estabelecimento_razaoSocial",
    "estalecimento_noFantasia",
    "estabelecimento_municipio_codigo",
    "estabelecimento_municipio_nome",
    "estabelecimento_uf",
    "vacina_grupoAtendimento_codigo",
    "vacina_grupoAtendimento_nome",
    "vacina_categoria_codigo",
    "vacina_categoria_nome",
    "vacina_lote",
    "vacina_fabricante_nome",
    "vacina_fabricante_referencia",
    "vacina_dataAplicacao",
    "vacina_descricao_dose",
    "vacina_codigo",
    "vacina_nome",
    "sistema_origem",
    "id_sistema_origem",
    "data_importacao_rnds",
    "redshift",
    "timestamp",
    "version",
    "year_month",
]

# --- fixed values: columns the source contract declares nullable ----------
CONTRACT_NULLABLE = {
    "paciente_nacionalidade_enumNacionalidade",
    "vacina_grupoAtendimento_nome",
    "vacina_categoria_codigo",
    "vacina_categoria_nome",
    "vacina_fabricante_referencia",
}

# The only non-text raw column.
_RAW_INT_COLUMNS = {"paciente_idade"}

RAW_VACCINATIONS = T.StructType(
    [
        T.StructField(c, T.IntegerType() if c in _RAW_INT_COLUMNS else T.StringType(), True)
        for c in RAW_VACCINATION_COLUMNS
    ]
)

# Contract types as declared by the source (JSON-schema names).
CONTRACT_TYPES = {c: ("integer" if c in _RAW_INT_COLUMNS else "string") for c in RAW_VACCINATION_COLUMNS}

RAW_POPULATION = T.StructType(
    [
        T.StructField("state", T.StringType(), True),
        T.StructField("state_ibge_code", T.IntegerType(), True),
        T.StructField("city_ibge_code", T.IntegerType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("estimated_population", T.IntegerType(), True),
    ]
)

# --- fixed values: raw -> staging (name, cast), in staging column order ----
# cast None = kept as text.
STAGING_COLUMNS = [
    ("document_id", "elasticsearch_document_id", None),
    ("paciente_id", "patient_id", None),
    ("paciente_idade", "patient_age", "int"),
    ("paciente_dataNascimento", "patient_birth_date", None),
    ("paciente_enumSexoBiologico", "patient_biological_gender_enum", None),
    ("paciente_racaCor_codigo", "patient_skin_color_code", None),
    ("paciente_racaCor_valor", "patient_skin_color_value", None),
    ("paciente_endereco_coIbgeMunicipio", "patient_address_city_ibge_code", None),
    ("paciente_endereco_nmMunicipio", "patient_address_city_name", None),
    ("paciente_endereco_uf", "patient_address_state_abbrev", None),
    ("paciente_endereco_coPais", "patient_address_country_code", None),
    ("paciente_endereco_nmPais", "patient_address_country_name", None),
    ("paciente_endereco_cep", "patient_address_postal_code", None),
    ("paciente_nacionalidade_enumNacionalidade", "patient_nationality_enum", None),
    ("estabelecimento_valor", "facility_code", "int"),
    ("estabelecimento_razaoSocial", "facility_registration_name", None),
    ("estalecimento_noFantasia", "facility_fantasy_name", None),
    ("estabelecimento_municipio_codigo", "facility_city_code", "int"),
    ("estabelecimento_municipio_nome", "facility_city_name", None),
    ("estabelecimento_uf", "facility_state_abbrev", None),
    ("vacina_categoria_codigo", "vaccination_category_code", None),
    ("vacina_categoria_nome", "vaccination_category_name", None),
    ("vacina_grupoAtendimento_codigo", "vaccination_subcategory_code", None),
    ("vacina_grupoAtendimento_nome", "vaccination_subcategory_name", None),
    ("vacina_lote", "vaccine_batch_code", None),
    ("vacina_fabricante_nome", "vaccine_manufacturer_name", None),
    ("vacina_fabricante_referencia", "vaccine_manufacturer_reference_code", None),
    ("vacina_dataAplicacao", "vaccination_date", "date"),
    ("vacina_descricao_dose", "vaccination_dose_description", None),
    ("vacina_codigo", "vaccine_type_code", "int"),
    ("vacina_nome", "vaccine_type_name", None),
    ("id_sistema_origem", "source_system_code", None),
    ("sistema_origem", "source_system_name", None),
    ("data_importacao_rnds", "data_loaded_from_rnds_date", "date"),
    ("redshift", "redshift", None),
    ("timestamp", "elasticsearch_timestamp", "timestamp_ntz"),
    ("version", "elasticsearch_version", None),
    ("year_month", "year_month", "date"),
]

# --- fixed values: surrogate keys, (key, staging columns hashed in order) --
SURROGATE_KEYS = [
    ("vaccination_sk", ["elasticsearch_document_id", "patient_id", "vaccination_date"]),
    ("patient_sk", ["patient_id"]),
    ("facility_sk", ["facility_code"]),
    ("vaccine_sk", ["vaccine_type_code", "vaccine_batch_code", "vaccination_dose_description"]),
    ("city_sk", ["patient_address_city_ibge_code"]),
]

# --- fixed values: dimension attributes, in output order -------------------
PATIENT_ATTRIBUTES = [
    "patient_id",
    "patient_age",
    "patient_birth_date",
    "patient_biological_gender_enum",
    "patient_skin_color_code",
    "patient_skin_color_value",
    "patient_address_city_ibge_code",
    "patient_address_city_name",
    "patient_address_state_abbrev",
    "patient_address_country_code",
    "patient_address_country_name",
    "patient_address_postal_code",
    "patient_nationality_enum",
    "vaccination_category_code",
    "vaccination_category_name",
    "vaccination_subcategory_code",
    "vaccination_subcategory_name",
]

FACILITY_ATTRIBUTES = [
    "facility_code",
    "facility_registration_name",
    "facility_fantasy_name",
    "facility_city_code",
    "facility_city_name",
    "facility_state_abbrev",
]

VACCINE_ATTRIBUTES = [
    "vaccination_dose_description",
    "vaccine_type_code",
    "vaccine_type_name",
    "vaccine_batch_code",
    "vaccine_manufacturer_name",
    "vaccine_manufacturer_reference_code",
]

FACT_COLUMNS = ["vaccination_sk", "patient_sk", "facility_sk", "vaccine_sk", "city_sk", "vaccination_date"]

# Landing layout partition columns (both also exist inside the files).
LANDING_PARTITIONS = ["year_month", "estabelecimento_uf"]
