"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them start from the driver's tables in ``sf_dir`` (read whole) and
map them to the vaccination model through ``vaxmart.sources.fixtures``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.functions.categories import normalize_category as _normalize
from vaxmart.functions.temporal import calendar_fields as _calendar_fields
from vaxmart.functions.temporal import load_mode as _load_mode
from vaxmart.functions.temporal import week_start, weeks_between
from vaxmart.functions.temporal import year_month as _year_month
from vaxmart.operators import ingest
from vaxmart.operators import merge as _merge
from vaxmart.operators import quality as dq
from vaxmart.operators.joins import anti_join_not_in as _anti_join
from vaxmart.operators.windows import moving_average
from vaxmart.operators.windows import percent_of_max as _pct_of_max
from vaxmart.operators.windows import running_total as _running_total
from vaxmart.plans import analytics, pipeline, sql_analyses
from vaxmart.plans.star import star_from_fixtures
from vaxmart.schemas import CONTRACT_NULLABLE, CONTRACT_TYPES, LANDING_PARTITIONS, RAW_VACCINATIONS
from vaxmart.session import apply_required_conf
from vaxmart.session import scratch_path
from vaxmart.sources import contracts, layouts, named
from vaxmart.sources import csv as _csv
from vaxmart.sources.fixtures import load_table, memo, raw_population, raw_vaccinations
from vaxmart.sources.tables import land_partitioned
from vaxmart.sources.versions import VersionedTable
from vaxmart.streaming.merge_stream import merge_batch_once, stream_merge, stream_merge_versioned

# Fixed "today" of the fixtures, so week-based results do not drift.
AS_OF = dt.date(2001, 11, 5)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_required_conf(spark)
        return fn(spark, sf_dir)

    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapped
    return wrapped


# --- staging, dimensions, fact ----------------------------------------------


@register
def stg_surrogate_keys(spark, sf_dir):
    """staging_vaccinations: 5 MD5 keys + 38 renamed/typed columns."""
    return star_from_fixtures(spark, sf_dir).staging


@register
def stg_rename_cast(spark, sf_dir):
    """Rename + cast only (38 columns)."""
    from vaxmart.operators.staging import rename_and_cast
    from vaxmart.sources.fixtures import raw_vaccinations

    return rename_and_cast(raw_vaccinations(spark, sf_dir))


@register
def fact_vaccinations(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).fact


@register
def dim_patients(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).patients


@register
def dim_facilities(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).facilities


@register
def dim_vaccines(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).vaccines


@register
def dim_cities(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).cities


@register
def dim_calendar(spark, sf_dir):
    return star_from_fixtures(spark, sf_dir).calendar


# --- analyses -----------------------------------------------------------------


@register
def cumulative_per_capita(spark, sf_dir):
    s = star_from_fixtures(spark, sf_dir)
    return analytics.cumulative_per_capita(s.fact, s.calendar, s.facilities, s.cities)


@register
def daily_per_capita_moving_avg(spark, sf_dir):
    """R2; the 30-row average is rounded to 10 digits (double sums differ in the last bits across engines)."""
    s = star_from_fixtures(spark, sf_dir)
    return analytics.daily_per_capita_moving_avg(s.fact, s.calendar, s.facilities, s.cities, round_digits=10)


@register
def weekly_by_type(spark, sf_dir):
    s = star_from_fixtures(spark, sf_dir)
    return analytics.weekly_by_type(s.fact, s.calendar, s.vaccines)


@register
def late_second_dose(spark, sf_dir):
    s = star_from_fixtures(spark, sf_dir)
    return analytics.late_second_dose(s.fact, s.vaccines, as_of=AS_OF)


# --- building blocks ------------------------------------------------------------


def _daily_orders(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderstatus", F.col("o_orderdate").cast("date").alias("order_date")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


@register
def state_population_preagg(spark, sf_dir):
    return analytics.state_populations(star_from_fixtures(spark, sf_dir).cities)


@register
def running_total(spark, sf_dir):
    """Running order count per status, one row per status and day."""
    return _running_total(_daily_orders(spark, sf_dir), ["o_orderstatus"], "order_date", "n_orders", "running_orders")


@register
def moving_average_rows(spark, sf_dir):
    """Average daily order count over the last 30 rows (not days) per status."""
    return moving_average(_daily_orders(spark, sf_dir), ["o_orderstatus"], "order_date", "n_orders", "avg_30_rows")


@register
def percent_of_max(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    per_priority = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    return _pct_of_max(per_priority, "n_orders", "pct_of_max")


@register
def normalize_category(spark, sf_dir):
    """Vaccine type rules applied to every vaccine of the dimension."""
    v = star_from_fixtures(spark, sf_dir).vaccines
    return v.select("vaccine_sk", "vaccine_type_name", _normalize("vaccine_type_name").alias("vaccine_type"))


@register
def stg_normalized_type(spark, sf_dir):
    """Staging with the normalised vaccine type as a column (vaccine_sk, type name, normalised type)."""
    from vaxmart.operators.staging import build_staging

    st = build_staging(raw_vaccinations(spark, sf_dir), normalized_type=True)
    return st.select("vaccination_sk", "vaccine_type_name", "vaccine_normalized_type")


@register
def week_boundaries(spark, sf_dir):
    """Week start (Monday) of each order and week boundaries crossed until the fixed as-of date."""
    orders = load_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        d.alias("order_date"),
        week_start(d).alias("week_start"),
        weeks_between(d, F.lit(AS_OF)).alias("weeks_since"),
    )


@register
def calendar_fields(spark, sf_dir):
    dates = load_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()
    return dates.select("full_date", *[c.alias(n) for n, c in _calendar_fields("full_date").items()])


@register
def year_month_bucket(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", _year_month("l_shipdate").alias("year_month"))


@register
def month_end_load_mode(spark, sf_dir):
    """Per distinct order date: full reload ('replace') on a month's last day, else 'append'."""
    dates = load_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    return dates.select("run_date", _load_mode("run_date").alias("load_mode"))


@register
def anti_join_not_in(spark, sf_dir):
    """Customers NOT IN the set of customers with an urgent order."""
    customer = load_table(spark, sf_dir, "customer")
    urgent = load_table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return _anti_join(customer, urgent, "c_custkey", "o_custkey")


@register
def union_all_summary(spark, sf_dir):
    """Three one-row summaries stacked with UNION ALL (names from the first branch)."""
    orders = load_table(spark, sf_dir, "orders")
    a = orders.agg(F.lit("Orders").alias("category"), F.count(F.lit(1)).alias("n"))
    b = orders.agg(F.lit("Customers with orders").alias("category"), F.countDistinct("o_custkey").alias("n"))
    c = orders.where(F.col("o_orderpriority") == "1-URGENT").agg(
        F.lit("Urgent orders").alias("category"), F.count(F.lit(1)).alias("n")
    )
    return a.unionByName(b).unionByName(c)


@register
def count_distinct_global(spark, sf_dir):
    fact = star_from_fixtures(spark, sf_dir).fact
    return fact.agg(F.countDistinct("patient_sk").alias("unique_patients"))


@register
def having_duplicates(spark, sf_dir):
    """(l_orderkey, l_linenumber) pairs that occur more than once."""
    return dq.duplicate_groups(load_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- data quality -----------------------------------------------------------------


@register
def dq_unique_fact(spark, sf_dir):
    return dq.check_unique(star_from_fixtures(spark, sf_dir).fact, "vaccination_sk", "fact_unique_vaccination_sk")


@register
def dq_unique_patient(spark, sf_dir):
    return dq.check_unique(star_from_fixtures(spark, sf_dir).patients, "patient_sk", "dim_patients_unique_patient_sk")


@register
def dq_not_null_fact(spark, sf_dir):
    return dq.check_not_null(star_from_fixtures(spark, sf_dir).fact, "vaccination_sk", "fact_not_null_vaccination_sk")


@register
def dq_not_null_patient(spark, sf_dir):
    return dq.check_not_null(
        star_from_fixtures(spark, sf_dir).patients, "patient_sk", "dim_patients_not_null_patient_sk"
    )


@register
def dq_distinct_states(spark, sf_dir):
    """Distinct facility states reached through the fact; the warehouse expects 6."""
    s = star_from_fixtures(spark, sf_dir)
    return dq.check_distinct_count(
        s.fact, s.facilities, "facility_sk", "facility_state_abbrev", 6, "fact_distinct_states_count"
    )


@register
def dq_unique_lineitem_fails(spark, sf_dir):
    """Negative check: (l_orderkey, l_linenumber) is not unique in the driver's lineitem."""
    return dq.check_unique(load_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem_unique_key")


@register
def dq_no_blank_key(spark, sf_dir):
    s = star_from_fixtures(spark, sf_dir)
    return dq.check_no_blank_key(s.fact, "patient_sk", "fact_no_blank_patient_sk")


@register
def dq_report(spark, sf_dir):
    return dq.run_checks(
        [QUERIES[n](spark, sf_dir) for n in
         ("dq_unique_fact", "dq_unique_patient", "dq_not_null_fact", "dq_not_null_patient", "dq_distinct_states")]
    )


@register
def contract_report(spark, sf_dir):
    return dq.contract_report(raw_vaccinations(spark, sf_dir))


@register
def contract_report_violations(spark, sf_dir):
    """The report on a table with a text age, without one column, and with one too many."""
    rows = raw_vaccinations(spark, sf_dir)
    age = F.col("paciente_idade").cast("string")
    return dq.contract_report(rows.withColumn("paciente_idade", age).drop("version").withColumn("note", F.col("vacina_lote")))


# --- physical layout ----------------------------------------------------------------


@register
def fact_written_layout(spark, sf_dir):
    """The fact written in date order, a hot date split by the row's own key, and read back."""
    from vaxmart.sources import tables

    fact = star_from_fixtures(spark, sf_dir).fact
    order = ["vaccination_date", "vaccination_sk"]
    path = scratch_path(spark, "fact")
    tables.rebuild_table(tables.write_layout(fact, range_by=order, sort_by=order), path)
    return spark.read.parquet(path)


# --- ingestion logic ---------------------------------------------------------------


# --- fixed values: the merge and extraction scenarios on the driver tables --
MERGE_MONTH = "1998-06-01"
MERGE_NEXT_MONTH = "1998-07-01"
EVENT_STATES = ["click", "error", "purchase", "signup", "view"]
PRIOR_RUN_STATES = ["click", "error", "purchase", "signup"]  # 'view' has no bookmark yet
PRIOR_RUN_UNTIL = "2024-01-14"
RUN_UNTIL = "2024-01-25"


def _orders_table(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    return orders.withColumn("year_month", _year_month("o_orderdate"))


def _orders_batch(target):
    """New rows for MERGE_MONTH: every row of the month with a changed price,
    the same rows under new (negated) keys, and the next month's rows as-is
    (rows of another partition whose keys also live there)."""
    month = target.where(F.col("year_month") == MERGE_MONTH)
    changed = month.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new_keys = month.withColumn("o_orderkey", -F.col("o_orderkey"))
    other = target.where(F.col("year_month") == MERGE_NEXT_MONTH)
    return changed.unionByName(new_keys).unionByName(other)


@register
def merge_partition(spark, sf_dir):
    target = _orders_table(spark, sf_dir)
    return _merge.merge_partition(target, _orders_batch(target), "o_orderkey", "year_month", MERGE_MONTH)


@register
def replace_partition(spark, sf_dir):
    target = _orders_table(spark, sf_dir)
    return _merge.replace_partition(target, _orders_batch(target), "year_month")


def _event_bookmarks(events):
    prior = ingest.incremental_extract(
        events, PRIOR_RUN_UNTIL, None, state_col="event_type", date_col="ts", states=PRIOR_RUN_STATES
    )
    return ingest.next_bookmarks(prior, None, state_col="event_type", date_col="ts")


@register
def incremental_extract(spark, sf_dir):
    events = load_table(spark, sf_dir, "events")
    return ingest.incremental_extract(
        events, RUN_UNTIL, _event_bookmarks(events), state_col="event_type", date_col="ts", states=EVENT_STATES
    )


@register
def next_bookmarks(spark, sf_dir):
    events = load_table(spark, sf_dir, "events")
    previous = _event_bookmarks(events)
    current = ingest.incremental_extract(
        events, RUN_UNTIL, previous, state_col="event_type", date_col="ts", states=EVENT_STATES
    )
    return ingest.next_bookmarks(current, previous, state_col="event_type", date_col="ts")


# --- landing files and streaming (these write under spark.checkpoint.dir) ----------


# --- fixed value: bad-row budget of the vaccination load -------------------
VACCINATION_MAX_ERRORS = 100


@register
def csv_roundtrip_land_and_load(spark, sf_dir):
    """Land the raw table as partitioned gzip CSV, then bulk-load it back
    through the positional reader with the bad-row budget."""
    base = scratch_path(spark, "landing")
    land_partitioned(raw_vaccinations(spark, sf_dir), base, mode="append", passes_by=["paciente_id"])
    return _csv.load_csv_to_table(
        spark, _csv.landing_glob(base), RAW_VACCINATIONS, scratch_path(spark, "raw_vaccinations"),
        max_errors=VACCINATION_MAX_ERRORS,
    )


@register
def stream_merge_available_now(spark, sf_dir):
    """Land the raw table, ingest the landing files with an availableNow
    stream that merges each micro-batch into a partitioned Parquet table,
    and return that table."""
    base = scratch_path(spark, "landing")
    target = scratch_path(spark, "raw_vaccinations")
    land_partitioned(raw_vaccinations(spark, sf_dir), base, mode="append", passes_by=["paciente_id"])
    query = stream_merge(spark, base, target, scratch_path(spark, "stream-ckpt"), pk="document_id")
    query.awaitTermination()
    return spark.read.schema(RAW_VACCINATIONS).parquet(target).select(*RAW_VACCINATIONS.names)


@register
def load_if_empty(spark, sf_dir):
    """Create the population table, load it, then try a second (different)
    load: it must be skipped because the table already has rows."""
    from vaxmart.schemas import RAW_POPULATION
    from vaxmart.sources.tables import ensure_table
    from vaxmart.sources.tables import load_if_empty as _load_if_empty

    path = scratch_path(spark, "raw_population")
    ensure_table(spark, path, RAW_POPULATION)
    pop = raw_population(spark, sf_dir)
    _load_if_empty(spark, path, pop)
    _load_if_empty(spark, path, pop.withColumn("estimated_population", F.col("estimated_population") * 2))
    return spark.read.parquet(path)


@register
def csv_reject_budget(spark, sf_dir):
    """Population CSV landed next to a file of region rows (two fields per
    line, so every one of them is malformed): the load keeps the population
    rows and passes while the rejects stay under the budget."""
    from vaxmart.schemas import RAW_POPULATION

    base = scratch_path(spark, "population-landing")
    pop = raw_population(spark, sf_dir)
    pop.write.option("header", True).csv(f"{base}/population")
    load_table(spark, sf_dir, "region").write.option("header", True).csv(f"{base}/stray")
    return _csv.load_csv_to_table(
        spark, f"{base}/*/*.csv", RAW_POPULATION, scratch_path(spark, "raw_population"),
        max_errors=VACCINATION_MAX_ERRORS,
    )


@register
def csv_rejects(spark, sf_dir):
    """Lines of landed ``region`` files read as population rows: all are
    rejected (the header lines are skipped) and kept as data."""
    from vaxmart.schemas import RAW_POPULATION

    base, target = scratch_path(spark, "stray"), scratch_path(spark, "raw_population")
    load_table(spark, sf_dir, "region").select("r_regionkey", "r_name").write.option("header", True).csv(base)
    _csv.load_csv_to_table(spark, f"{base}/*.csv", RAW_POPULATION, target, max_errors=VACCINATION_MAX_ERRORS)
    return _csv.read_rejects(spark, target).select(F.trim("record").alias("record"), "lines")


@register
def read_partition(spark, sf_dir):
    """One month of the landed raw table, read alone."""
    base = scratch_path(spark, "landing")
    land_partitioned(raw_vaccinations(spark, sf_dir), base, mode="append", passes_by=["paciente_id"])
    return _csv.read_partition(spark, base, "year_month", "1998-06-01", RAW_VACCINATIONS)


@register
def land_documents(spark, sf_dir):
    """Prose with quotes, commas and line breaks, landed by language and read back."""
    docs = load_table(spark, sf_dir, "documents")
    base = scratch_path(spark, "documents-landing")
    land_partitioned(docs, base, mode="append", partition_by=["lang"])
    return _csv.load_csv(spark, _csv.landing_glob(base, ["lang"]), docs.schema)


def _orders_with_null_months(spark, sf_dir):
    """Orders, every seventh without a month; batches of changed and new keys, null months among them."""
    orders = load_table(spark, sf_dir, "orders")
    month = F.when(F.col("o_orderkey") % 7 != 0, F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-01"))
    target = orders.select("o_orderkey", "o_totalprice", month.alias("year_month"))
    some = (F.col("year_month") == "1998-06-01") | F.col("year_month").isNull()
    changed = target.where(some & (F.col("o_orderkey") % 2 == 0)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return target, changed.union(changed.withColumn("o_orderkey", -F.col("o_orderkey")))


@register
def write_merge_on_disk(spark, sf_dir):
    """The partition merge on disk, for one month; rows without a month are a partition of their own."""
    from vaxmart.sources.tables import rebuild_table

    target, batch = _orders_with_null_months(spark, sf_dir)
    path = scratch_path(spark, "orders")
    rebuild_table(target, path, partition_by=["year_month"])
    _merge.write_merge(spark, path, batch, "o_orderkey", "year_month", "1998-06-01", schema=target.schema)
    return spark.read.schema(target.schema).parquet(path).select(*target.columns)


@register
def stream_merge_two_batches(spark, sf_dir):
    """Two runs of the stream: the orders, then changed and new ones, null months among them."""
    target, batch = _orders_with_null_months(spark, sf_dir)
    base, path, ckpt = (scratch_path(spark, n) for n in ("orders-landing", "orders", "orders-ckpt"))
    for rows in (target, batch):
        land_partitioned(rows, base, mode="append", partition_by=["year_month"])
        stream_merge(spark, base, path, ckpt, pk="o_orderkey", schema=target.schema, partitions=["year_month"]).awaitTermination()
    return spark.read.schema(target.schema).parquet(path).select(*target.columns)


@register
def rebuild_table(spark, sf_dir):
    """Drop and create: the second build replaces the first whole, partitions it does not have too."""
    from vaxmart.sources import tables

    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "orders")
    tables.rebuild_table(orders, path, partition_by=["o_orderstatus"])
    tables.rebuild_table(orders.where("o_orderstatus <> 'F'"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus")


# --- fixed value: run date of the daily-extraction scenario -------------------
DAILY_RUN_UNTIL = dt.date(1998, 6, 15)


@register
def daily_extract_to_landing(spark, sf_dir):
    """The daily extract job over the raw table as source: the month of the run
    date up to that date is landed (no bookmarks yet), then read back."""
    landing = scratch_path(spark, "landing")
    ingest.extract_to_landing(
        spark, raw_vaccinations(spark, sf_dir), landing, scratch_path(spark, "bookmarks"), DAILY_RUN_UNTIL
    )
    return _csv.load_csv_to_table(
        spark, _csv.landing_glob(landing), RAW_VACCINATIONS, scratch_path(spark, "raw_vaccinations"),
        max_errors=VACCINATION_MAX_ERRORS,
    )


@register
def month_end_replace(spark, sf_dir):
    """An append run, then the month-end run over a source in which one state
    has no rows any more: its landed rows go, too."""
    landing, bookmarks = scratch_path(spark, "landing"), scratch_path(spark, "bookmarks")
    source = raw_vaccinations(spark, sf_dir)
    ingest.extract_to_landing(spark, source, landing, bookmarks, DAILY_RUN_UNTIL)
    later = source.where("estabelecimento_uf <> 'ASIA'")
    ingest.extract_to_landing(spark, later, landing, bookmarks, dt.date(1998, 6, 30))
    return _csv.load_csv(spark, _csv.landing_glob(landing), RAW_VACCINATIONS)


@register
def check_scalar(spark, sf_dir):
    """A query's single value against the expected one."""
    flags = load_table(spark, sf_dir, "lineitem").agg(F.count_distinct("l_returnflag").alias("n"))
    dq.check_scalar(flags, 3)
    return flags


# --- writes that are all or nothing ---------------------------------------------------

# The months of the merge, and the last one, in which the first attempt fails.
VERSIONED_MONTHS = ["1997-03-01", "1997-04-01", "1997-05-01"]


def _versioned_orders(spark, sf_dir):
    orders = _orders_table(spark, sf_dir)
    table = VersionedTable(spark, scratch_path(spark, "orders-versions"), orders.schema, ("year_month",))
    with table.transaction() as tx:
        tx.rebuild(orders)
    return table, orders


def _merge_months(table, orders, fails_in=None):
    """Each month's changed rows and as many new keys, merged in one transaction."""
    with table.transaction() as tx:
        for month in VERSIONED_MONTHS:
            rows = orders.where(F.col("year_month") == month)
            price = F.col("o_totalprice") + 1
            if month == fails_in:
                price = F.when(F.col("o_totalprice") > 0, F.raise_error(F.lit("a bad row"))).otherwise(price).cast("double")
            changed = rows.withColumn("o_totalprice", price)
            tx.merge(changed.union(changed.withColumn("o_orderkey", -F.col("o_orderkey"))), "o_orderkey", month)


def _failing(step, *args, **kwargs):
    try:
        step(*args, **kwargs)
    except (PySparkException, _csv.RejectBudgetExceeded):
        return
    raise AssertionError("the step was expected to fail")


@register
def versioned_merge_failed(spark, sf_dir):
    """Three months merged in one transaction that fails in the last: readers see the table as it was."""
    table, orders = _versioned_orders(spark, sf_dir)
    _failing(_merge_months, table, orders, fails_in=VERSIONED_MONTHS[-1])
    return table.read()


@register
def versioned_merge_rerun(spark, sf_dir):
    """The same, run again without the bad row."""
    table, orders = _versioned_orders(spark, sf_dir)
    _failing(_merge_months, table, orders, fails_in=VERSIONED_MONTHS[-1])
    _merge_months(table, orders)
    return table.read()


@register
def versioned_rebuild_failed(spark, sf_dir):
    """Drop and create that fails while it writes: the old table stays whole."""
    table, orders = _versioned_orders(spark, sf_dir)

    def rebuild():
        with table.transaction() as tx:
            tx.rebuild(orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, F.raise_error(F.lit("a bad row"))).otherwise("X")))

    _failing(rebuild)
    return table.read()


@register
def versioned_replace_partitions(spark, sf_dir):
    """Months replaced by the rows of a batch; one of them is emptied."""
    table, orders = _versioned_orders(spark, sf_dir)
    batch = orders.where(F.col("year_month") == VERSIONED_MONTHS[0]).withColumn("o_totalprice", -F.col("o_totalprice"))
    with table.transaction() as tx:
        tx.replace(batch, [{"year_month": m} for m in VERSIONED_MONTHS[:2]])
    return table.read()


def _versioned_landing(spark, sf_dir):
    landing = VersionedTable(spark, scratch_path(spark, "landing-versions"), RAW_VACCINATIONS, LANDING_PARTITIONS, fmt="csv")
    source, bookmarks = raw_vaccinations(spark, sf_dir), scratch_path(spark, "bookmarks")

    def run(rows, until):
        ingest.extract_to_landing(spark, rows, "", bookmarks, until, landing=landing)

    run(source, DAILY_RUN_UNTIL)
    run(source, DAILY_RUN_UNTIL)  # repeated: lands nothing twice
    later = source.where("estabelecimento_uf <> 'ASIA'")
    bad = later.withColumn("vacina_lote", F.when(F.col("vacina_lote").isNotNull(), F.raise_error(F.lit("a bad row"))).otherwise("x"))
    _failing(run, bad, dt.date(1998, 6, 30))
    return landing, run, later


@register
def landing_after_failed_replace(spark, sf_dir):
    """A month-end replace that fails while it writes: the files landed before stay."""
    return _versioned_landing(spark, sf_dir)[0].read()


@register
def landing_replaced_on_rerun(spark, sf_dir):
    """The month-end replace run again: the month is the new extract, one state gone."""
    landing, run, later = _versioned_landing(spark, sf_dir)
    run(later, dt.date(1998, 6, 30))
    return landing.read()


@register
def stream_replayed_batches(spark, sf_dir):
    """Two batches with repeated keys merged by a stream's ledger, each handed over twice: the second time does nothing."""
    target, batch = _orders_with_null_months(spark, sf_dir)
    table = VersionedTable(spark, scratch_path(spark, "orders-stream"), target.schema, ("year_month",))
    for n, rows in enumerate((target.union(target), batch.union(batch))):
        for _ in range(2):
            merge_batch_once(table, rows, f"stream#{n}", "o_orderkey")
    return table.read()


@register
def stream_merge_versioned_two_batches(spark, sf_dir):
    """Two runs of the stream into a versioned table: the orders, then changed and new ones."""
    target, batch = _orders_with_null_months(spark, sf_dir)
    base, ckpt = scratch_path(spark, "orders-landing"), scratch_path(spark, "orders-ckpt")
    table = VersionedTable(spark, scratch_path(spark, "orders-stream"), target.schema, ("year_month",))
    for rows in (target, batch):
        land_partitioned(rows, base, mode="append", partition_by=["year_month"])
        stream_merge_versioned(base, table, ckpt, pk="o_orderkey", partitions=["year_month"]).awaitTermination()
    return table.read()


# --- one parse: good rows and rejects ---------------------------------------------------

# Fixed value: a load fails with this many rejected lines.
SMALL_BUDGET = 10


def _order_lines(spark, sf_dir):
    """Orders as CSV lines, of which every tenth has a bad price and every eleventh no last field."""
    orders = load_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    price = F.when(key % 10 == 3, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    line = F.when(key % 11 == 5, F.concat_ws(",", key, price)).otherwise(F.concat_ws(",", key, price, "o_orderstatus"))
    base = scratch_path(spark, "order-lines")
    orders.select(line.alias("value")).write.text(base)
    schema = orders.select("o_orderkey", "o_totalprice", "o_orderstatus").schema
    return f"{base}/*.txt", VersionedTable(spark, scratch_path(spark, "orders-load"), schema), orders.count()


@register
def csv_load_one_parse(spark, sf_dir):
    """The good lines of a load within its budget."""
    path, table, n = _order_lines(spark, sf_dir)
    with table.transaction() as tx:
        tx.load_csv(path, max_errors=n, header=False)
    return table.read()


@register
def csv_rejects_of_orders(spark, sf_dir):
    """The rejected lines of that load."""
    path, table, n = _order_lines(spark, sf_dir)
    with table.transaction() as tx:
        tx.load_csv(path, max_errors=n, header=False)
    return table.read_rejects().select(F.trim("record").alias("record"), "lines")


@register
def csv_over_budget(spark, sf_dir):
    """A load within budget, then the same lines with a small one: it fails, the table stays, its rejects are kept, too."""
    path, table, n = _order_lines(spark, sf_dir)
    with table.transaction() as tx:
        tx.load_csv(path, max_errors=n, header=False, load="first")

    def again():
        with table.transaction() as tx:
            tx.load_csv(path, max_errors=SMALL_BUDGET, header=False, load="second")

    _failing(again)
    rows = table.read().agg(F.lit("table").alias("part"), F.count(F.lit(1)).alias("n"))
    return rows.unionByName(table.read_rejects().groupBy(F.col("load").alias("part")).agg(F.sum("lines").alias("n")))


# --- tables by name, layouts, checks in one scan ---------------------------------------


def _named_star(spark, sf_dir):
    """Database of the star written from the driver's tables; written once a session and directory."""
    def build():
        root = scratch_path(spark, "warehouse")
        pipeline.run(spark, raw_vaccinations(spark, sf_dir), raw_population(spark, sf_dir), root, raise_on_failure=False,
                     passes_by=["paciente_id"])
        database = "star_" + hashlib.md5(sf_dir.encode()).hexdigest()[:10]
        named.register_star(spark, pipeline.Warehouse(root), database)
        return database

    return memo(spark, ("named star", sf_dir), build)


@register
def sql_cumulative_per_capita(spark, sf_dir):
    return sql_analyses.run(spark, sql_analyses.CUMULATIVE_PER_CAPITA, _named_star(spark, sf_dir))


@register
def sql_daily_per_capita(spark, sf_dir):
    return sql_analyses.run(spark, sql_analyses.DAILY_PER_CAPITA, _named_star(spark, sf_dir))


@register
def sql_weekly_by_type(spark, sf_dir):
    return sql_analyses.run(spark, sql_analyses.WEEKLY_BY_TYPE, _named_star(spark, sf_dir))


@register
def sql_late_second_dose(spark, sf_dir):
    return sql_analyses.run(spark, sql_analyses.LATE_SECOND_DOSE, _named_star(spark, sf_dir), AS_OF)


@register
def sql_named_partition(spark, sf_dir):
    """One month of the staging table by name: its partitions were registered from the folders."""
    rows = spark.table(f"{_named_star(spark, sf_dir)}.staging_vaccinations").where("year_month = DATE '1998-06-01'")
    return rows.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))


BUCKETS = 16


def _bucketed_star(spark, sf_dir):
    def build():
        database = _named_star(spark, sf_dir)
        for table in ("fact_vaccinations", "dim_patients"):
            layouts.write_bucketed(spark.table(f"{database}.{table}"), f"{database}.{table}_by_patient", scratch_path(spark, f"{table}-buckets"),
                                   "patient_sk", BUCKETS, hot_keys=[dq.BLANK_KEY])
        return database

    return memo(spark, ("bucketed star", sf_dir), build)


@register
def bucketed_fact_patients(spark, sf_dir):
    """Vaccinations by patient state and age from the fact and the patients, joined bucket by bucket."""
    database = _bucketed_star(spark, sf_dir)
    joined = layouts.join_bucketed(spark, f"{database}.fact_vaccinations_by_patient", f"{database}.dim_patients_by_patient", "patient_sk",
                                   hot_keys=[dq.BLANK_KEY])
    return joined.groupBy("patient_address_state_abbrev", "patient_age").agg(F.sum("vaccinations_count").alias("vaccinations"))


@register
def interleaved_fact_two_predicates(spark, sf_dir):
    """The fact in interleaved order of date and facility; rows of one quarter and of half the facility keys."""
    database, path = _named_star(spark, sf_dir), scratch_path(spark, "fact-interleaved")
    layouts.write_interleaved(spark.table(f"{database}.fact_vaccinations"), path, ["vaccination_date", "facility_sk"], 16, ["vaccination_sk"])
    rows = spark.read.parquet(path)
    return rows.where((F.col("vaccination_date") >= F.lit("1998-01-01").cast("date")) & (F.col("vaccination_date") < F.lit("1998-04-01").cast("date"))
                      & (F.col("facility_sk") < "8"))


@register
def bloom_patient_lookup(spark, sf_dir):
    """All rows of the patient with the greatest key, from a fact with Bloom filters on the patient."""
    database, path = _named_star(spark, sf_dir), scratch_path(spark, "fact-bloom")
    fact = spark.table(f"{database}.fact_vaccinations")
    layouts.write_with_bloom_filters(fact, path, {"patient_sk": 50_000})
    key = fact.agg(F.max("patient_sk").alias("k")).first()["k"]
    return spark.read.parquet(path).where(F.col("patient_sk") == key)


@register
def dq_fact_in_one_scan(spark, sf_dir):
    s = star_from_fixtures(spark, sf_dir)
    return dq.check_fact(s.fact, s.facilities, "vaccination_sk", "facility_sk", "facility_state_abbrev", 6)


@register
def dq_lineitem_in_one_scan_fails(spark, sf_dir):
    """The same on a key that repeats and is null for some rows."""
    lines = load_table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey")).alias("l_orderkey"), "l_suppkey")
    supplier = load_table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return dq.check_fact(lines, supplier, "l_orderkey", "l_suppkey", "s_nationkey", 25, prefix="lineitem")


@register
def contract_from_document(spark, sf_dir):
    """The contract read from its JSON document, held against a table with a text age, one column missing and one too many."""
    path = scratch_path(spark, "contract")
    document = contracts.contract_document("vaccinations", CONTRACT_TYPES, CONTRACT_NULLABLE)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(path)
    contract = contracts.read_contract(spark, path, "vaccinations")
    rows = raw_vaccinations(spark, sf_dir)
    age = F.col("paciente_idade").cast("string")
    return contract.report(rows.withColumn("paciente_idade", age).drop("version").withColumn("note", F.col("vacina_lote")))
