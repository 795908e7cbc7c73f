"""DuckDB SQL oracle for every registered query.

Written from the warehouse model's semantics, independently of the Spark
code in ``vaxmart``. The driver tables (lineitem, orders, ...) are views;
the vaccination-shaped raw tables and the star are CTEs built here.
DuckDB dialect notes: ``date_trunc`` returns a timestamp (cast back to
date), ``extract`` returns BIGINT (cast to int), ``sum(int)`` is HUGEINT
(cast to bigint), week differences are computed from Monday-truncated dates.
"""

from __future__ import annotations

AS_OF = "DATE '2001-11-05'"

RAW_VACCINATIONS_CTE = """
raw_vaccinations AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS document_id,
    CAST(l_orderkey AS VARCHAR) AS paciente_id,
    CAST(l_orderkey % 100 AS INTEGER) AS paciente_idade,
    CAST(1920 + l_orderkey % 100 AS VARCHAR) || '-01-01' AS paciente_dataNascimento,
    CASE WHEN l_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS paciente_enumSexoBiologico,
    substring(o_orderpriority, 1, 1) AS paciente_racaCor_codigo,
    substring(o_orderpriority, 3, 20) AS paciente_racaCor_valor,
    CAST(120000 + c_nationkey AS VARCHAR) AS paciente_endereco_coIbgeMunicipio,
    '10' AS paciente_endereco_coPais,
    cn.n_name AS paciente_endereco_nmMunicipio,
    'BRASIL' AS paciente_endereco_nmPais,
    cr.r_name AS paciente_endereco_uf,
    lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS paciente_endereco_cep,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE 'B' END AS paciente_nacionalidade_enumNacionalidade,
    lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS estabelecimento_valor,
    s_name AS estabelecimento_razaoSocial,
    'Posto ' || s_name AS estalecimento_noFantasia,
    CAST(120000 + s_nationkey AS VARCHAR) AS estabelecimento_municipio_codigo,
    sn.n_name AS estabelecimento_municipio_nome,
    sr.r_name AS estabelecimento_uf,
    o_orderstatus AS vacina_grupoAtendimento_codigo,
    CASE o_orderstatus WHEN 'F' THEN 'Faixa Etaria' WHEN 'O' THEN 'Saude' END AS vacina_grupoAtendimento_nome,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE substring(c_mktsegment, 1, 2) END AS vacina_categoria_codigo,
    nullif(c_mktsegment, 'MACHINERY') AS vacina_categoria_nome,
    p_brand AS vacina_lote,
    'FAB ' || p_type AS vacina_fabricante_nome,
    CASE WHEN p_type = 'STANDARD' THEN NULL ELSE 'Organization/' || p_type END AS vacina_fabricante_referencia,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T00:00:00.000Z' AS vacina_dataAplicacao,
    CASE l_returnflag WHEN 'A' THEN '1ª Dose' WHEN 'N' THEN '2ª Dose' ELSE 'Dose Única' END AS vacina_descricao_dose,
    CASE p_type WHEN 'ECONOMY' THEN '85' WHEN 'LARGE' THEN '86' WHEN 'MEDIUM' THEN '87' WHEN 'PROMO' THEN '88'
         WHEN 'SMALL' THEN '89' ELSE CASE WHEN p_size > 25 THEN '99' ELSE '90' END END AS vacina_codigo,
    CASE p_type WHEN 'ECONOMY' THEN 'Coronavac-Sinovac/Butantan' WHEN 'LARGE' THEN 'Vacina Covishield'
         WHEN 'MEDIUM' THEN 'Oxford/AstraZeneca' WHEN 'PROMO' THEN 'BioNTech/Pfizer' WHEN 'SMALL' THEN 'Janssen-Cilag'
         ELSE CASE WHEN p_size > 25 THEN 'Pendente Identificação' ELSE 'Outra' END END AS vacina_nome,
    'Novo PNI' AS sistema_origem,
    '16341' AS id_sistema_origem,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T12:34:56.000Z' AS data_importacao_rnds,
    'x' AS redshift,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T01:02:03.000Z' AS "timestamp",
    '1' AS version,
    substring(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 7) || '-01' AS year_month
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

RAW_POPULATION_CTE = """
raw_population AS (
  SELECT r_name AS state, CAST(10 + n_regionkey AS INTEGER) AS state_ibge_code,
         CAST((120000 + n_nationkey) * 10 + n_nationkey % 10 AS INTEGER) AS city_ibge_code,
         n_name AS city, CAST(1000 * (n_nationkey + 1) AS INTEGER) AS estimated_population
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

RENAMED_CTE = """
renamed AS (
  SELECT
    document_id AS elasticsearch_document_id,
    paciente_id AS patient_id,
    CAST(paciente_idade AS INTEGER) AS patient_age,
    paciente_dataNascimento AS patient_birth_date,
    paciente_enumSexoBiologico AS patient_biological_gender_enum,
    paciente_racaCor_codigo AS patient_skin_color_code,
    paciente_racaCor_valor AS patient_skin_color_value,
    paciente_endereco_coIbgeMunicipio AS patient_address_city_ibge_code,
    paciente_endereco_nmMunicipio AS patient_address_city_name,
    paciente_endereco_uf AS patient_address_state_abbrev,
    paciente_endereco_coPais AS patient_address_country_code,
    paciente_endereco_nmPais AS patient_address_country_name,
    paciente_endereco_cep AS patient_address_postal_code,
    paciente_nacionalidade_enumNacionalidade AS patient_nationality_enum,
    CAST(estabelecimento_valor AS INTEGER) AS facility_code,
    estabelecimento_razaoSocial AS facility_registration_name,
    estalecimento_noFantasia AS facility_fantasy_name,
    CAST(estabelecimento_municipio_codigo AS INTEGER) AS facility_city_code,
    estabelecimento_municipio_nome AS facility_city_name,
    estabelecimento_uf AS facility_state_abbrev,
    vacina_categoria_codigo AS vaccination_category_code,
    vacina_categoria_nome AS vaccination_category_name,
    vacina_grupoAtendimento_codigo AS vaccination_subcategory_code,
    vacina_grupoAtendimento_nome AS vaccination_subcategory_name,
    vacina_lote AS vaccine_batch_code,
    vacina_fabricante_nome AS vaccine_manufacturer_name,
    vacina_fabricante_referencia AS vaccine_manufacturer_reference_code,
    CAST(substring(vacina_dataAplicacao, 1, 10) AS DATE) AS vaccination_date,
    vacina_descricao_dose AS vaccination_dose_description,
    CAST(vacina_codigo AS INTEGER) AS vaccine_type_code,
    vacina_nome AS vaccine_type_name,
    id_sistema_origem AS source_system_code,
    sistema_origem AS source_system_name,
    CAST(substring(data_importacao_rnds, 1, 10) AS DATE) AS data_loaded_from_rnds_date,
    redshift AS redshift,
    CAST(replace(replace("timestamp", 'T', ' '), 'Z', '') AS TIMESTAMP) AS elasticsearch_timestamp,
    version AS elasticsearch_version,
    CAST(year_month AS DATE) AS year_month
  FROM raw_vaccinations
)"""

STAGING_CTE = """
staging AS (
  SELECT
    md5(coalesce(elasticsearch_document_id, '') || coalesce(CAST(patient_id AS VARCHAR), '')
        || coalesce(CAST(vaccination_date AS VARCHAR), '')) AS vaccination_sk,
    md5(coalesce(CAST(patient_id AS VARCHAR), '')) AS patient_sk,
    md5(coalesce(CAST(facility_code AS VARCHAR), '')) AS facility_sk,
    md5(coalesce(CAST(vaccine_type_code AS VARCHAR), '') || coalesce(vaccine_batch_code, '')
        || coalesce(vaccination_dose_description, '')) AS vaccine_sk,
    md5(coalesce(patient_address_city_ibge_code, '')) AS city_sk,
    renamed.*
  FROM renamed
)"""

FACT_CTE = """
fact AS (
  SELECT vaccination_sk, patient_sk, facility_sk, vaccine_sk, city_sk, vaccination_date,
         1 AS vaccinations_count
  FROM staging
)"""

PATIENTS_CTE = """
dim_patients AS (
  SELECT patient_sk,
    max(patient_id) AS patient_id,
    CAST(max(patient_age) AS INTEGER) AS patient_age,
    max(patient_birth_date) AS patient_birth_date,
    max(patient_biological_gender_enum) AS patient_biological_gender_enum,
    max(patient_skin_color_code) AS patient_skin_color_code,
    max(patient_skin_color_value) AS patient_skin_color_value,
    max(patient_address_city_ibge_code) AS patient_address_city_ibge_code,
    max(patient_address_city_name) AS patient_address_city_name,
    max(patient_address_state_abbrev) AS patient_address_state_abbrev,
    max(patient_address_country_code) AS patient_address_country_code,
    max(patient_address_country_name) AS patient_address_country_name,
    max(patient_address_postal_code) AS patient_address_postal_code,
    max(patient_nationality_enum) AS patient_nationality_enum,
    max(vaccination_category_code) AS vaccination_category_code,
    max(vaccination_category_name) AS vaccination_category_name,
    max(vaccination_subcategory_code) AS vaccination_subcategory_code,
    max(vaccination_subcategory_name) AS vaccination_subcategory_name
  FROM staging GROUP BY patient_sk
)"""

FACILITIES_CTE = """
dim_facilities AS (
  SELECT facility_sk,
    max(facility_code) AS facility_code,
    max(facility_registration_name) AS facility_registration_name,
    max(facility_fantasy_name) AS facility_fantasy_name,
    max(facility_city_code) AS facility_city_code,
    max(facility_city_name) AS facility_city_name,
    max(facility_state_abbrev) AS facility_state_abbrev
  FROM staging GROUP BY facility_sk
)"""

VACCINES_CTE = """
dim_vaccines AS (
  SELECT vaccine_sk,
    max(vaccination_dose_description) AS vaccination_dose_description,
    max(vaccine_type_code) AS vaccine_type_code,
    max(vaccine_type_name) AS vaccine_type_name,
    max(vaccine_batch_code) AS vaccine_batch_code,
    max(vaccine_manufacturer_name) AS vaccine_manufacturer_name,
    max(vaccine_manufacturer_reference_code) AS vaccine_manufacturer_reference_code
  FROM staging GROUP BY vaccine_sk
)"""

CITIES_CTE = """
dim_cities AS (
  SELECT md5(coalesce(substring(CAST(city_ibge_code AS VARCHAR), 1, 6), '')) AS city_sk,
         raw_population.*,
         substring(CAST(city_ibge_code AS VARCHAR), 1, 6) AS cropped_city_ibge_code
  FROM raw_population
)"""

CALENDAR_CTE = """
dim_calendar AS (
  SELECT vaccination_date AS full_date,
    CAST(extract(day FROM vaccination_date) AS INTEGER) AS day,
    CAST(extract(week FROM vaccination_date) AS INTEGER) AS week,
    CAST(extract(month FROM vaccination_date) AS INTEGER) AS month,
    CAST(extract(year FROM vaccination_date) AS INTEGER) AS year,
    CAST(extract(dow FROM vaccination_date) AS INTEGER) AS weekday
  FROM fact GROUP BY vaccination_date
)"""

NORMALIZE_SQL = """CASE
      WHEN lower({c}) LIKE '%butantan%' THEN 'Coronavac'
      WHEN lower({c}) LIKE '%astrazeneca%' OR lower({c}) LIKE '%covishield%' THEN 'AstraZeneca'
      WHEN lower({c}) LIKE '%pfizer%' THEN 'Pfizer'
      WHEN lower({c}) LIKE '%janssen%' THEN 'Janssen'
      ELSE {c} END"""

STATE_POP_CTE = """
state_populations AS (
  SELECT state, CAST(sum(estimated_population) AS BIGINT) AS state_population
  FROM dim_cities GROUP BY state
)"""

_STAR = [RAW_VACCINATIONS_CTE, RAW_POPULATION_CTE, RENAMED_CTE, STAGING_CTE, FACT_CTE, PATIENTS_CTE,
         FACILITIES_CTE, VACCINES_CTE, CITIES_CTE, CALENDAR_CTE, STATE_POP_CTE]


def with_star(body: str, *extra_ctes: str) -> str:
    """Prefix ``body`` with the star-schema CTEs (DuckDB inlines unused ones)."""
    return "WITH " + ",\n".join(list(_STAR) + list(extra_ctes)) + "\n" + body


def weeks_between_sql(a: str, b: str) -> str:
    return (f"CAST(date_diff('day', CAST(date_trunc('week', {a}) AS DATE), "
            f"CAST(date_trunc('week', {b}) AS DATE)) / 7 AS INTEGER)")


ORACLE: dict[str, str] = {}

ORACLE["stg_surrogate_keys"] = with_star("SELECT * FROM staging")
ORACLE["stg_rename_cast"] = with_star("SELECT * FROM renamed")
ORACLE["fact_vaccinations"] = with_star("SELECT * FROM fact")
ORACLE["dim_patients"] = with_star("SELECT * FROM dim_patients")
ORACLE["dim_facilities"] = with_star("SELECT * FROM dim_facilities")
ORACLE["dim_vaccines"] = with_star("SELECT * FROM dim_vaccines")
ORACLE["dim_cities"] = with_star("SELECT * FROM dim_cities")
ORACLE["dim_calendar"] = with_star("SELECT * FROM dim_calendar")

# R1 and R2 start from doses by state and day; output names are fixed values.
_STATE_DAYS = """
tally AS (SELECT facility_sk, vaccination_date, sum(vaccinations_count) AS doses FROM fact GROUP BY ALL),
state_day AS (
  SELECT d.facility_state_abbrev AS state, t.vaccination_date, sum(t.doses) AS doses
  FROM tally t JOIN dim_facilities d USING (facility_sk)
  WHERE t.vaccination_date IN (SELECT full_date FROM dim_calendar)
    AND d.facility_state_abbrev IN (SELECT state FROM state_populations)
  GROUP BY ALL
)"""

# Every day joined to the state's days up to it.
ORACLE["cumulative_per_capita"] = with_star(
    """
SELECT today.vaccination_date, today.state, people.state_population, CAST(today.doses AS BIGINT) AS daily_vaccinations,
       CAST(sum(past.doses) AS DOUBLE) AS cumulative_daily_vaccinations,
       CAST(sum(past.doses) AS DOUBLE) / people.state_population AS cumulative_daily_vaccinations_per_capta
FROM state_day today
JOIN state_day past ON past.state = today.state AND past.vaccination_date <= today.vaccination_date
JOIN state_populations people ON people.state = today.state
GROUP BY today.vaccination_date, today.state, people.state_population, today.doses""",
    _STATE_DAYS,
)

# Days numbered by state; each meets itself and the 29 before.
ORACLE["daily_per_capita_moving_avg"] = with_star(
    """
SELECT x.vaccination_date, x.state, x.rate AS vaccinations_per_capta, round(avg(y.rate), 10) AS rolling_avg_30_days
FROM numbered x JOIN numbered y ON y.state = x.state AND y.nth BETWEEN x.nth - 29 AND x.nth
GROUP BY x.vaccination_date, x.state, x.rate""",
    _STATE_DAYS,
    """
numbered AS (
  SELECT vaccination_date, state, CAST(doses AS DOUBLE) / state_population AS rate,
         rank() OVER (PARTITION BY state ORDER BY vaccination_date) AS nth
  FROM state_day JOIN state_populations USING (state)
)""",
)

ORACLE["weekly_by_type"] = with_star(
    f"""
SELECT period, label AS vaccine_type, CAST(sum(doses) AS BIGINT) AS total_vaccinations
FROM week_counts JOIN labels USING (vaccine_sk)
GROUP BY period, label""",
    """
week_counts AS (
  SELECT vaccine_sk, CAST(date_trunc('week', vaccination_date) AS DATE) AS period, sum(vaccinations_count) AS doses
  FROM fact WHERE vaccination_date IN (SELECT full_date FROM dim_calendar) GROUP BY ALL
)""",
    f"""
labels AS (
  SELECT vaccine_sk, {NORMALIZE_SQL.format(c='vaccine_type_name')} AS label
  FROM dim_vaccines WHERE vaccine_type_name <> 'Pendente Identificação'
)""",
)

# One row a patient answers all three questions; the labels are fixed values.
ORACLE["late_second_dose"] = with_star(
    """
SELECT category, unique_patients_count,
       round(100 * (CAST(unique_patients_count AS DOUBLE) / greatest(everyone, twice, late)), 2) AS pct_of_total
FROM (
  SELECT *, unnest(['All patients', 'Already took 2 doses ', 'Late to take 2nd dose']) AS category,
         unnest([everyone, twice, late]) AS unique_patients_count
  FROM totals
)
ORDER BY category""",
    f"""
patient AS (
  SELECT f.patient_sk, count(*) AS n,
         bool_or(v.vaccination_dose_description = '1ª Dose' AND {weeks_between_sql('f.vaccination_date', AS_OF)} >= 5) AS overdue
  FROM fact f JOIN dim_vaccines v USING (vaccine_sk)
  WHERE {NORMALIZE_SQL.format(c='v.vaccine_type_name')} = 'Coronavac'
  GROUP BY f.patient_sk
)""",
    """
totals AS (
  SELECT count(*) AS everyone, count(*) FILTER (n > 1) AS twice, count(*) FILTER (n = 1 AND overdue) AS late FROM patient
)""",
)

# --- building blocks -------------------------------------------------------------

ORACLE["state_population_preagg"] = with_star("SELECT * FROM state_populations")

_DAILY_ORDERS = """
daily_orders AS (
  SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, count(*) AS n_orders
  FROM orders GROUP BY 1, 2
)"""

ORACLE["running_total"] = f"""WITH {_DAILY_ORDERS}
SELECT *, CAST(sum(n_orders) OVER (PARTITION BY o_orderstatus ORDER BY order_date
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_orders
FROM daily_orders"""

ORACLE["moving_average_rows"] = f"""WITH {_DAILY_ORDERS}
SELECT *, avg(n_orders) OVER (PARTITION BY o_orderstatus ORDER BY order_date
          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS avg_30_rows
FROM daily_orders"""

ORACLE["percent_of_max"] = """
SELECT o_orderpriority, n_orders,
       round(100 * (CAST(n_orders AS DOUBLE) / max(n_orders) OVER ()), 2) AS pct_of_max
FROM (SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1)"""

ORACLE["normalize_category"] = with_star(
    f"SELECT vaccine_sk, vaccine_type_name, {NORMALIZE_SQL.format(c='vaccine_type_name')} AS vaccine_type "
    "FROM dim_vaccines")

ORACLE["week_boundaries"] = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS week_start,
       {weeks_between_sql('CAST(o_orderdate AS DATE)', AS_OF)} AS weeks_since
FROM orders"""

ORACLE["calendar_fields"] = """
SELECT full_date,
  CAST(extract(day FROM full_date) AS INTEGER) AS day,
  CAST(extract(week FROM full_date) AS INTEGER) AS week,
  CAST(extract(month FROM full_date) AS INTEGER) AS month,
  CAST(extract(year FROM full_date) AS INTEGER) AS year,
  CAST(extract(dow FROM full_date) AS INTEGER) AS weekday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders)"""

ORACLE["year_month_bucket"] = """
SELECT l_orderkey, l_linenumber, strftime(CAST(l_shipdate AS DATE), '%Y-%m-01') AS year_month FROM lineitem"""

ORACLE["month_end_load_mode"] = """
SELECT run_date, CASE WHEN last_day(run_date) = run_date THEN 'replace' ELSE 'append' END AS load_mode
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)"""

ORACLE["anti_join_not_in"] = """
SELECT * FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""

ORACLE["union_all_summary"] = """
SELECT 'Orders' AS category, count(*) AS n FROM orders
UNION ALL SELECT 'Customers with orders', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'Urgent orders', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'"""

ORACLE["count_distinct_global"] = with_star("SELECT count(DISTINCT patient_sk) AS unique_patients FROM fact")

ORACLE["having_duplicates"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

# --- data quality ------------------------------------------------------------------


def _dq(check: str, count_sql: str, expected: int) -> str:
    return (f"SELECT '{check}' AS \"check\", CAST(observed AS BIGINT) AS observed, "
            f"CAST({expected} AS BIGINT) AS expected, observed = {expected} AS passed "
            f"FROM (SELECT ({count_sql}) AS observed)")


def _repeated(table: str, *key: str) -> str:
    return (f"SELECT count(*) FILTER (n > 1) FROM (SELECT count(*) AS n FROM {table} GROUP BY {', '.join(key)})")


def _null_key(table: str, key: str) -> str:
    return f"SELECT CAST(count(*) > count({key}) AS BIGINT) FROM {table}"


_DQ_SQL = {
    "dq_unique_fact": _dq("fact_unique_vaccination_sk", _repeated("fact", "vaccination_sk"), 0),
    "dq_unique_patient": _dq("dim_patients_unique_patient_sk", _repeated("dim_patients", "patient_sk"), 0),
    "dq_not_null_fact": _dq("fact_not_null_vaccination_sk", _null_key("fact", "vaccination_sk"), 0),
    "dq_not_null_patient": _dq("dim_patients_not_null_patient_sk", _null_key("dim_patients", "patient_sk"), 0),
    "dq_distinct_states": _dq(
        "fact_distinct_states_count",
        "SELECT count(DISTINCT facility_state_abbrev) + CAST(count(*) > count(facility_state_abbrev) AS BIGINT) "
        "FROM dim_facilities WHERE facility_sk IN (SELECT facility_sk FROM fact)", 6),
}
for _name, _sql in _DQ_SQL.items():
    ORACLE[_name] = with_star(_sql)

ORACLE["dq_report"] = with_star("\nUNION ALL\n".join(f"({s})" for s in _DQ_SQL.values()))

ORACLE["dq_unique_lineitem_fails"] = _dq(
    "lineitem_unique_key",
    _repeated("lineitem", "l_orderkey", "l_linenumber"), 0)

ORACLE["dq_no_blank_key"] = with_star(_dq(
    "fact_no_blank_patient_sk",
    "SELECT count(*) FROM fact WHERE patient_sk = 'd41d8cd98f00b204e9800998ecf8427e'", 0))


# The contract's columns in order, the only one that is no text, and those that may be null.
_CONTRACT = """
document_id paciente_id paciente_idade paciente_dataNascimento paciente_enumSexoBiologico paciente_racaCor_codigo
paciente_racaCor_valor paciente_endereco_coIbgeMunicipio paciente_endereco_coPais paciente_endereco_nmMunicipio
paciente_endereco_nmPais paciente_endereco_uf paciente_endereco_cep paciente_nacionalidade_enumNacionalidade
estabelecimento_valor estabelecimento_razaoSocial estalecimento_noFantasia estabelecimento_municipio_codigo
estabelecimento_municipio_nome estabelecimento_uf vacina_grupoAtendimento_codigo vacina_grupoAtendimento_nome
vacina_categoria_codigo vacina_categoria_nome vacina_lote vacina_fabricante_nome vacina_fabricante_referencia
vacina_dataAplicacao vacina_descricao_dose vacina_codigo vacina_nome sistema_origem id_sistema_origem
data_importacao_rnds redshift timestamp version year_month
""".split()
_CONTRACT_INTEGER = "paciente_idade"
_CONTRACT_NULLABLE = """
paciente_nacionalidade_enumNacionalidade vacina_grupoAtendimento_nome vacina_categoria_codigo vacina_categoria_nome
vacina_fabricante_referencia
""".split()


def _contract_sql(mistyped: str = "", missing: str = "", extra: str = "", extra_from: str = "") -> str:
    counts = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS n{i}' for i, c in enumerate(_CONTRACT))
    branches = []
    for i, c in enumerate(_CONTRACT):
        nullable = "TRUE" if c in _CONTRACT_NULLABLE else "FALSE"
        kind = "integer" if c == _CONTRACT_INTEGER else "string"
        nulls = "NULL" if c == missing else f"n{i}"
        passed = "FALSE" if c in (missing, mistyped) else f"({nullable} OR n{i} = 0)"
        branches.append(
            f"SELECT '{c}' AS column_name, '{kind}' AS declared_type, {nullable} AS declared_nullable, "
            f"{c != missing} AS present, CAST({nulls} AS BIGINT) AS null_count, {passed} AS passed FROM counts"
        )
    if extra:
        branches.append(f"SELECT '{extra}', NULL, NULL, TRUE, CAST(n{_CONTRACT.index(extra_from)} AS BIGINT), FALSE FROM counts")
    return with_star("\nUNION ALL\n".join(branches), f"counts AS MATERIALIZED (SELECT {counts} FROM raw_vaccinations)")


ORACLE["contract_report"] = _contract_sql()
ORACLE["contract_report_violations"] = _contract_sql("paciente_idade", "version", "note", "vacina_lote")
ORACLE["fact_written_layout"] = with_star("SELECT * FROM fact")

# --- ingestion logic -----------------------------------------------------------------

_ORDERS_T = """
target AS (SELECT *, strftime(CAST(o_orderdate AS DATE), '%Y-%m-01') AS year_month FROM orders),
batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority,
         year_month FROM target WHERE year_month = '1998-06-01'
  UNION ALL
  SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, year_month
  FROM target WHERE year_month = '1998-06-01'
  UNION ALL
  SELECT * FROM target WHERE year_month = '1998-07-01'
)"""

ORACLE["merge_partition"] = f"""WITH {_ORDERS_T}
SELECT * FROM target
WHERE year_month IS DISTINCT FROM '1998-06-01' OR o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL
SELECT * FROM batch"""

ORACLE["replace_partition"] = f"""WITH {_ORDERS_T}
SELECT * FROM target WHERE year_month NOT IN (SELECT DISTINCT year_month FROM batch)
UNION ALL
SELECT * FROM batch"""

_EVENTS_BM = """
prior AS (
  SELECT * FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-14'
    AND event_type IN ('click', 'error', 'purchase', 'signup')
),
bookmarks AS (SELECT event_type AS state, max(CAST(ts AS DATE)) AS last_date FROM prior GROUP BY 1),
extracted AS (
  SELECT e.* FROM events e LEFT JOIN bookmarks b ON e.event_type = b.state
  WHERE CAST(e.ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-25'
    AND e.event_type IN ('click', 'error', 'purchase', 'signup', 'view')
    AND (b.last_date IS NULL OR CAST(e.ts AS DATE) > b.last_date)
)"""

ORACLE["incremental_extract"] = f"WITH {_EVENTS_BM}\nSELECT * FROM extracted"

ORACLE["next_bookmarks"] = f"""WITH {_EVENTS_BM},
new_bm AS (SELECT event_type AS state, max(CAST(ts AS DATE)) AS new_date FROM extracted GROUP BY 1)
SELECT coalesce(n.state, b.state) AS state, greatest(n.new_date, b.last_date) AS last_date
FROM new_bm n FULL OUTER JOIN bookmarks b ON n.state = b.state"""

# --- landing files and streaming: the table that was landed comes back whole ------
ORACLE["csv_roundtrip_land_and_load"] = with_star("SELECT * FROM raw_vaccinations")
ORACLE["stream_merge_available_now"] = with_star("SELECT * FROM raw_vaccinations")
ORACLE["stg_normalized_type"] = with_star(
    f"SELECT vaccination_sk, vaccine_type_name, {NORMALIZE_SQL.format(c='vaccine_type_name')} AS vaccine_normalized_type "
    "FROM staging")
ORACLE["load_if_empty"] = with_star("SELECT * FROM raw_population")
ORACLE["csv_reject_budget"] = with_star("SELECT * FROM raw_population")
ORACLE["daily_extract_to_landing"] = with_star(
    "SELECT * FROM raw_vaccinations "
    "WHERE CAST(substring(vacina_dataAplicacao, 1, 10) AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-15'")

ORACLE["csv_rejects"] = "SELECT CAST(r_regionkey AS VARCHAR) || ',' || r_name AS record, CAST(1 AS BIGINT) AS lines FROM region"
ORACLE["read_partition"] = with_star("SELECT * FROM raw_vaccinations WHERE year_month = '1998-06-01'")
ORACLE["land_documents"] = "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents"

_NULL_MONTHS = """
target AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderkey % 7 <> 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-01') END AS year_month FROM orders
),
changed AS (
  SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, year_month FROM target
  WHERE (year_month = '1998-06-01' OR year_month IS NULL) AND o_orderkey % 2 = 0
),
batch AS (SELECT * FROM changed UNION ALL SELECT -o_orderkey, o_totalprice, year_month FROM changed)"""

ORACLE["write_merge_on_disk"] = f"""WITH {_NULL_MONTHS}
SELECT * FROM target
WHERE year_month IS DISTINCT FROM '1998-06-01' OR o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL
SELECT * FROM batch"""

ORACLE["stream_merge_two_batches"] = f"""WITH {_NULL_MONTHS}
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey AND b.year_month IS NOT DISTINCT FROM t.year_month)
UNION ALL
SELECT * FROM batch"""

ORACLE["rebuild_table"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'"
ORACLE["month_end_replace"] = with_star(
    "SELECT * FROM raw_vaccinations WHERE estabelecimento_uf <> 'ASIA' "
    "AND CAST(substring(vacina_dataAplicacao, 1, 10) AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'")
ORACLE["check_scalar"] = "SELECT count(DISTINCT l_returnflag) AS n FROM lineitem"

# --- writes that are all or nothing ---------------------------------------------------

_ORDERS_BY_MONTH = "orders_by_month AS (SELECT *, strftime(CAST(o_orderdate AS DATE), '%Y-%m-01') AS year_month FROM orders)"
_MONTHS = "('1997-03-01', '1997-04-01', '1997-05-01')"
ORACLE["versioned_merge_failed"] = ORACLE["versioned_rebuild_failed"] = f"WITH {_ORDERS_BY_MONTH} SELECT * FROM orders_by_month"
ORACLE["versioned_merge_rerun"] = f"""WITH {_ORDERS_BY_MONTH}
SELECT * REPLACE (o_totalprice + CASE WHEN year_month IN {_MONTHS} THEN 1 ELSE 0 END AS o_totalprice) FROM orders_by_month
UNION ALL
SELECT * REPLACE (-o_orderkey AS o_orderkey, o_totalprice + 1 AS o_totalprice) FROM orders_by_month WHERE year_month IN {_MONTHS}"""
ORACLE["versioned_replace_partitions"] = f"""WITH {_ORDERS_BY_MONTH}
SELECT * REPLACE (CASE WHEN year_month = '1997-03-01' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice)
FROM orders_by_month WHERE year_month <> '1997-04-01'"""
ORACLE["landing_after_failed_replace"] = ORACLE["daily_extract_to_landing"]
ORACLE["landing_replaced_on_rerun"] = ORACLE["month_end_replace"]
ORACLE["stream_replayed_batches"] = f"""WITH {_NULL_MONTHS},
twice AS (SELECT * FROM target UNION ALL SELECT * FROM target)
SELECT * FROM twice t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey AND b.year_month IS NOT DISTINCT FROM t.year_month)
UNION ALL
SELECT * FROM batch
UNION ALL
SELECT * FROM batch"""
ORACLE["stream_merge_versioned_two_batches"] = ORACLE["stream_merge_two_batches"]

_BAD_LINES = """
lines AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderkey % 10 = 3 AS bad_price, o_orderkey % 11 = 5 AS short FROM orders
)"""
ORACLE["csv_load_one_parse"] = f"""WITH {_BAD_LINES}
SELECT o_orderkey, o_totalprice, o_orderstatus FROM lines WHERE NOT bad_price AND NOT short"""
ORACLE["csv_rejects_of_orders"] = f"""WITH {_BAD_LINES}
SELECT CAST(o_orderkey AS VARCHAR) || ',' || CASE WHEN bad_price THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END
       || CASE WHEN short THEN '' ELSE ',' || o_orderstatus END AS record, CAST(1 AS BIGINT) AS lines
FROM lines WHERE bad_price OR short"""
ORACLE["csv_over_budget"] = f"""WITH {_BAD_LINES}
SELECT 'table' AS part, count(*) AS n FROM lines WHERE NOT bad_price AND NOT short
UNION ALL
SELECT part, CAST(n AS BIGINT) FROM (SELECT count(*) AS n FROM lines WHERE bad_price OR short), (VALUES ('first'), ('second')) v(part)"""

# --- tables by name, layouts, checks in one scan ---------------------------------------

ORACLE["sql_cumulative_per_capita"] = ORACLE["cumulative_per_capita"]
ORACLE["sql_daily_per_capita"] = ORACLE["daily_per_capita_moving_avg"]
ORACLE["sql_weekly_by_type"] = ORACLE["weekly_by_type"]
ORACLE["sql_late_second_dose"] = ORACLE["late_second_dose"]
ORACLE["sql_named_partition"] = with_star(
    "SELECT year_month, count(*) AS n FROM staging WHERE year_month = DATE '1998-06-01' GROUP BY 1")
ORACLE["bucketed_fact_patients"] = with_star(
    """SELECT patient_address_state_abbrev, patient_age, CAST(sum(vaccinations_count) AS BIGINT) AS vaccinations
FROM fact JOIN dim_patients USING (patient_sk) GROUP BY 1, 2""")
ORACLE["interleaved_fact_two_predicates"] = with_star(
    """SELECT * FROM fact
WHERE vaccination_date >= DATE '1998-01-01' AND vaccination_date < DATE '1998-04-01' AND facility_sk < '8'""")
ORACLE["bloom_patient_lookup"] = with_star("SELECT * FROM fact WHERE patient_sk = (SELECT max(patient_sk) FROM fact)")
ORACLE["dq_fact_in_one_scan"] = with_star(
    """SELECT "check", CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected, observed = expected AS passed FROM (
  SELECT 'fact_unique_vaccination_sk' AS "check", count(*) AS observed, 0 AS expected
  FROM (SELECT vaccination_sk FROM fact GROUP BY 1 HAVING count(*) > 1)
  UNION ALL
  SELECT 'fact_not_null_vaccination_sk', count(*), 0 FROM (SELECT vaccination_sk FROM fact GROUP BY 1 HAVING vaccination_sk IS NULL)
  UNION ALL
  SELECT 'fact_distinct_facility_state_abbrev', count(*), 6
  FROM (SELECT DISTINCT facility_state_abbrev FROM fact JOIN dim_facilities USING (facility_sk)))""")
ORACLE["dq_lineitem_in_one_scan_fails"] = """
WITH l AS (SELECT CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END AS k, l_suppkey FROM lineitem)
SELECT "check", CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected, observed = expected AS passed FROM (
  SELECT 'lineitem_unique_l_orderkey' AS "check", count(*) AS observed, 0 AS expected FROM (SELECT k FROM l GROUP BY 1 HAVING count(*) > 1)
  UNION ALL
  SELECT 'lineitem_not_null_l_orderkey', count(*), 0 FROM (SELECT k FROM l GROUP BY 1 HAVING k IS NULL)
  UNION ALL
  SELECT 'lineitem_distinct_s_nationkey', count(*), 25
  FROM (SELECT DISTINCT s_nationkey FROM l JOIN supplier ON s_suppkey = l_suppkey))"""
ORACLE["contract_from_document"] = ORACLE["contract_report_violations"]
