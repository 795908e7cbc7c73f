"""CSV loading, landing layout, merge/replace, tables, streaming, bookmarks."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from vaxmart.operators import ingest, merge
from vaxmart.schemas import RAW_POPULATION, RAW_VACCINATIONS
from vaxmart.sources import csv as vcsv
from vaxmart.sources.tables import ensure_table, is_empty, land_partitioned, load_if_empty, write_layout
from vaxmart.streaming.merge_stream import stream_merge

from .test_operators import raw_row

POP_HEADER = "state,state_ibge_code,city_ibge_code,city,estimated_population\n"


def write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def test_csv_quotes_newlines_gzip_and_header_per_file(spark, workdir):
    write(f"{workdir}/a.csv", POP_HEADER + 'SC,42,4200051,"Abdon ""Batista"", SC",2653\n')
    write(f"{workdir}/b.csv.gz", POP_HEADER + 'RS,43,4300034,"Line\nbreak",3000\n', gz=True)
    load = vcsv.read_csv_bulk(spark, [f"{workdir}/a.csv", f"{workdir}/b.csv.gz"], RAW_POPULATION, max_errors=0)
    rows = sorted(load.good.collect())
    assert [r.city for r in rows] == ['Line\nbreak', 'Abdon "Batista", SC'][::-1] or [r.city for r in rows] == [
        "Line\nbreak", 'Abdon "Batista", SC']
    assert load.check_budget() == 0
    assert {r.state_ibge_code for r in rows} == {42, 43}


@pytest.mark.parametrize("n_bad,budget,ok", [(0, 0, True), (1, 0, False), (2, 3, True), (3, 3, False), (4, 3, False)])
def test_reject_budget(spark, workdir, n_bad, budget, ok):
    bad = ["SC,x,1,a,1", "SC,1,1", "SC,1,1,a,1,extra", "SC,1,1,a,notint"]
    lines = ["SC,42,4200051,A,10"] + bad[:n_bad]
    write(f"{workdir}/p.csv", POP_HEADER + "\n".join(lines) + "\n")
    load = vcsv.read_csv_bulk(spark, f"{workdir}/p.csv", RAW_POPULATION, max_errors=budget)
    assert load.reject_count() == n_bad
    assert len(load.good.collect()) == 1
    assert len(load.rejects.collect()) == n_bad
    for mode in ("before", "during"):
        target = f"{workdir}/t-{mode}"
        if ok:
            got = vcsv.load_csv_to_table(spark, f"{workdir}/p.csv", RAW_POPULATION, target, budget, budget_check=mode)
            assert got.count() == 1
        else:
            with pytest.raises(vcsv.RejectBudgetExceeded):
                vcsv.load_csv_to_table(spark, f"{workdir}/p.csv", RAW_POPULATION, target, budget, budget_check=mode)
            assert (mode == "during") == os.path.exists(target)  # "before" writes nothing
    if ok:
        assert len(vcsv.load_csv(spark, f"{workdir}/p.csv", RAW_POPULATION, max_errors=budget).collect()) == 1
    else:
        with pytest.raises(vcsv.RejectBudgetExceeded):
            vcsv.load_csv(spark, f"{workdir}/p.csv", RAW_POPULATION, max_errors=budget)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_VACCINATIONS)


def test_landing_round_trip_ignores_trash_and_keeps_in_file_values(spark, workdir):
    base = f"{workdir}/landing"
    rows = [raw_row(document_id=f"d{i}", estabelecimento_uf=uf, year_month=ym)
            for i, (uf, ym) in enumerate([("SC", "2021-07-01"), ("RS", "2021-07-01"), ("SC", "2021-08-01")])]
    land_partitioned(_raw(spark, rows), base, mode="append")
    assert os.path.isdir(f"{base}/year_month=2021-07-01/estabelecimento_uf=SC")
    # a left-over trash folder under a partition must not be read
    trash = f"{base}/year_month=2021-07-01/estabelecimento_uf=SC/trash/old.csv"
    write(trash, ",".join(RAW_VACCINATIONS.names) + "\n" + ",".join(["zz"] * 38) + "\n")
    got = vcsv.load_csv(spark, vcsv.landing_glob(base), RAW_VACCINATIONS, max_errors=0)
    assert sorted(r.document_id for r in got.collect()) == ["d0", "d1", "d2"]
    # the in-file value is what is loaded, even when it differs from the path
    odd = f"{base}/year_month=2021-09-01/estabelecimento_uf=PR/x.csv"
    write(odd, ",".join(RAW_VACCINATIONS.names) + "\n" + ",".join(
        "" if v is None else str(v) for v in raw_row(document_id="d9", estabelecimento_uf="XX")) + "\n")
    got = vcsv.load_csv(spark, vcsv.landing_glob(base), RAW_VACCINATIONS, max_errors=0)
    assert got.where("document_id = 'd9'").first().estabelecimento_uf == "XX"
    one = vcsv.read_partition(spark, base, "year_month", "2021-07-01", RAW_VACCINATIONS)
    assert sorted(r.document_id for r in one.collect()) == ["d0", "d1"]


def test_landing_replace_touches_only_present_partitions(spark, workdir):
    base = f"{workdir}/landing"
    land_partitioned(_raw(spark, [raw_row(document_id="a", estabelecimento_uf="SC"),
                                  raw_row(document_id="b", estabelecimento_uf="RS")]), base)
    land_partitioned(_raw(spark, [raw_row(document_id="c", estabelecimento_uf="SC")]), base, mode="replace")
    got = vcsv.load_csv(spark, vcsv.landing_glob(base), RAW_VACCINATIONS)
    assert sorted(r.document_id for r in got.collect()) == ["b", "c"]
    assert spark.read.parquet  # noqa: B018


def _orders(spark, rows):
    return spark.createDataFrame(rows, "pk int, v string, ym string")


def test_merge_partition_keeps_warehouse_semantics(spark, workdir):
    target = _orders(spark, [(1, "old", "2021-07"), (2, "keep", "2021-07"), (3, "other", "2021-06"),
                             (4, "x", "2021-08")])
    batch = _orders(spark, [(1, "new", "2021-07"), (3, "dup-pk-other-partition", "2021-07"),
                            (5, "a", "2021-07"), (5, "b", "2021-07"), (6, "other-month", "2021-08")])
    got = sorted(tuple(r) for r in merge.merge_partition(target, batch, "pk", "ym", "2021-07").collect())
    assert got == sorted([
        (1, "new", "2021-07"), (2, "keep", "2021-07"), (3, "other", "2021-06"), (4, "x", "2021-08"),
        (3, "dup-pk-other-partition", "2021-07"), (5, "a", "2021-07"), (5, "b", "2021-07"),
        (6, "other-month", "2021-08"),
    ])
    # on disk: only the touched partitions are rewritten, same rows as the lazy form
    path = f"{workdir}/t"
    target.write.partitionBy("ym").parquet(path)
    merge.write_merge(spark, path, batch, "pk", "ym", "2021-07")
    disk = sorted(tuple(r) for r in spark.read.parquet(path).select("pk", "v", "ym").collect())
    assert disk == got
    replaced = sorted(tuple(r) for r in merge.replace_partition(target, batch, "ym").collect())
    assert replaced == sorted([(3, "other", "2021-06")] + [tuple(r) for r in batch.collect()])


def test_write_merge_can_empty_the_loaded_partition(spark, workdir):
    target = _orders(spark, [(1, "a", "2021-07"), (2, "b", "2021-07"), (3, "c", "2021-06")])
    batch = _orders(spark, [(1, "moved", "2021-08"), (2, "moved", "2021-08")])
    path = f"{workdir}/t"
    target.write.partitionBy("ym").parquet(path)
    merge.write_merge(spark, path, batch, "pk", "ym", "2021-07")
    disk = sorted(tuple(r) for r in spark.read.parquet(path).select("pk", "v", "ym").collect())
    lazy = sorted(tuple(r) for r in merge.merge_partition(target, batch, "pk", "ym", "2021-07").collect())
    assert disk == lazy == [(1, "moved", "2021-08"), (2, "moved", "2021-08"), (3, "c", "2021-06")]


def test_merge_twice_equals_merge_once(spark):
    target = _orders(spark, [(1, "old", "2021-07"), (2, "keep", "2021-07")])
    batch = _orders(spark, [(1, "new", "2021-07"), (7, "n", "2021-07")])
    once = merge.merge_partition(target, batch, "pk", "ym", "2021-07")
    twice = merge.merge_partition(once, batch, "pk", "ym", "2021-07")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_ensure_and_load_if_empty(spark, workdir):
    path = f"{workdir}/pop"
    assert ensure_table(spark, path, RAW_POPULATION).count() == 0
    assert is_empty(spark, path)
    df = spark.createDataFrame([("SC", 42, 4200051, "A", 10)], RAW_POPULATION)
    assert load_if_empty(spark, path, df) is True
    assert load_if_empty(spark, path, df) is False  # already populated: skipped
    assert spark.read.parquet(path).count() == 1


def test_write_layout_shapes(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert write_layout(df, distribute_by=["k"], num_partitions=4).rdd.getNumPartitions() == 4
    ranged = write_layout(df, range_by=["id"], sort_by=["id"], num_partitions=5)
    assert ranged.rdd.getNumPartitions() == 5


def test_stream_merge_picks_up_only_new_files(spark, workdir):
    base, target, ckpt = f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/ckpt"
    land_partitioned(_raw(spark, [raw_row(document_id="a"), raw_row(document_id="b")]), base)
    stream_merge(spark, base, target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    # a new file with an update of "a" and a new row "c"
    land_partitioned(_raw(spark, [raw_row(document_id="a", vacina_lote="L2"), raw_row(document_id="c")]), base)
    stream_merge(spark, base, target, ckpt).awaitTermination()
    rows = {r.document_id: r.vacina_lote for r in spark.read.parquet(target).collect()}
    assert rows == {"a": "L2", "b": "L1", "c": "L1"}


def test_incremental_extract_bookmark_rules(spark):
    src = spark.createDataFrame(
        [(s, dt.date(2021, 7, d)) for s in ("SC", "RS", "PR") for d in (1, 10, 18, 19, 25)] + [("SC", dt.date(2021, 6, 30))],
        "state string, date date",
    )
    bm = spark.createDataFrame([("SC", dt.date(2021, 7, 18)), ("RS", None)], "state string, last_date date")
    got = ingest.incremental_extract(src, "2021-07-19", bm, states=["SC", "RS", "PR"])
    pairs = sorted((r.state, r.date.day) for r in got.collect())
    assert pairs == sorted([("SC", 19)] + [(s, d) for s in ("RS", "PR") for d in (1, 10, 18, 19)])
    inclusive = ingest.incremental_extract(src, "2021-07-19", bm, states=["SC"], inclusive=True)
    assert sorted(r.date.day for r in inclusive.collect()) == [18, 19]
    # bookmark equal to the until-date: nothing new
    same = ingest.incremental_extract(src, "2021-07-18", bm, states=["SC"])
    assert same.count() == 0
    nb = {r.state: r.last_date for r in ingest.next_bookmarks(got, bm).collect()}
    assert nb == {"SC": dt.date(2021, 7, 19), "RS": dt.date(2021, 7, 19), "PR": dt.date(2021, 7, 19)}
    assert ingest.parse_bookmark("SC|2021-07-18") == ("SC", dt.date(2021, 7, 18))
    assert ingest.parse_bookmark(None) is None
    assert ingest.format_bookmark("SC", dt.date(2021, 7, 18)) == "SC|2021-07-18"


def test_extract_to_landing_daily_runs(spark, workdir):
    from vaxmart.operators.ingest import extract_to_landing, latest_bookmarks

    days = [1, 5, 10, 18, 19, 25, 31]
    rows = [raw_row(document_id=f"{uf}{d}", estabelecimento_uf=uf, year_month="2021-07-01",
                    vacina_dataAplicacao=f"2021-07-{d:02d}T00:00:00.000Z") for uf in ("SC", "RS") for d in days]
    source = _raw(spark, rows)
    landing, bm = f"{workdir}/landing", f"{workdir}/bookmarks"

    def landed():
        return sorted(r.document_id for r in vcsv.load_csv(spark, vcsv.landing_glob(landing), RAW_VACCINATIONS).collect())

    assert extract_to_landing(spark, source, landing, bm, dt.date(2021, 7, 10)) == "append"
    assert landed() == sorted(f"{uf}{d}" for uf in ("SC", "RS") for d in (1, 5, 10))
    assert extract_to_landing(spark, source, landing, bm, dt.date(2021, 7, 19)) == "append"
    assert landed() == sorted(f"{uf}{d}" for uf in ("SC", "RS") for d in (1, 5, 10, 18, 19))
    marks = {r.state: r.last_date for r in latest_bookmarks(spark, bm, "2021-07-20").collect()}
    assert marks == {"SC": dt.date(2021, 7, 19), "RS": dt.date(2021, 7, 19)}
    # re-running the same day resumes from that day's bookmarks: nothing is landed twice
    extract_to_landing(spark, source, landing, bm, dt.date(2021, 7, 19))
    assert landed() == sorted(f"{uf}{d}" for uf in ("SC", "RS") for d in (1, 5, 10, 18, 19))
    marks = {r.state: r.last_date for r in latest_bookmarks(spark, bm, "2021-07-19").collect()}
    assert marks == {"SC": dt.date(2021, 7, 19), "RS": dt.date(2021, 7, 19)}
    # month end: the month is extracted whole and its partitions replaced (no duplicates)
    assert extract_to_landing(spark, source, landing, bm, dt.date(2021, 7, 31)) == "replace"
    assert landed() == sorted(f"{uf}{d}" for uf in ("SC", "RS") for d in days)


def test_write_replace_keeps_untouched_partitions(spark, workdir):
    path = f"{workdir}/t"
    _orders(spark, [(1, "a", "m1"), (2, "b", "m2"), (3, "c", "m3")]).write.partitionBy("ym").parquet(path)
    merge.write_replace(_orders(spark, [(9, "z", "m2"), (8, "y", "m4")]), path, "ym")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("pk", "v", "ym").collect())
    assert got == [(1, "a", "m1"), (3, "c", "m3"), (8, "y", "m4"), (9, "z", "m2")]


def test_load_to_partitioned_table_and_file_size_cap(spark, workdir):
    base = f"{workdir}/landing"
    rows = [raw_row(document_id=f"d{i}", year_month="2021-07-01" if i % 2 else "2021-08-01") for i in range(20)]
    land_partitioned(_raw(spark, rows), base, max_records_per_file=3)
    files = [f for _, _, fs in os.walk(base) for f in fs if f.endswith(".csv.gz")]
    assert len(files) >= 8  # 10 rows per month directory, at most 3 per file
    table = vcsv.load_csv_to_table(spark, vcsv.landing_glob(base), RAW_VACCINATIONS, f"{workdir}/raw",
                                   partition_by=["year_month"])
    assert table.count() == 20
    dirs = sorted(d for d in os.listdir(f"{workdir}/raw") if d.startswith("year_month="))
    assert dirs == ["year_month=2021-07-01", "year_month=2021-08-01"]


def test_stream_batch_adds_where_no_key_repeats(spark, workdir):
    """A second batch rewrites only the partition in which it repeats a key; files of the others stay."""
    import glob

    from vaxmart.streaming.merge_stream import merge_batch_into

    schema = spark.createDataFrame([], "k string, v int, p string").schema
    path = f"{workdir}/t"
    ensure_table(spark, path, schema, ["p"])

    def batch(*rows):
        merge_batch_into(spark, spark.createDataFrame(rows, schema), path, "k", "p", schema)
        return sorted(((r.k, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect()), key=repr)

    first = [("a", 1, "x"), ("b", 1, "y"), ("c", 1, None), ("d", 1, "z")]
    assert batch(*first) == sorted(first, key=repr)
    kept = set(glob.glob(f"{path}/p=x/*.parquet") + glob.glob(f"{path}/p=__HIVE*/*.parquet"))
    second = [("e", 2, "x"), ("b", 2, "y"), ("b", 2, "y"), ("f", 2, None), ("a", 2, "new")]
    want = sorted([r for r in first if r[0] != "b"] + second, key=repr)
    assert batch(*second) == want
    assert kept <= set(glob.glob(f"{path}/p=*/*.parquet"))
    assert batch(*second) == want  # replayed
