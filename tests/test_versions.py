"""Versioned tables: commits are all or nothing, readers see one state, replays do nothing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vaxmart.sources import csv as vcsv
from vaxmart.sources.versions import ConcurrentCommit, VersionedTable, partition_values

ROWS = [(1, "a", "2021-01-01"), (2, "b", "2021-02-01"), (3, "c", None), (4, "d", "x/y: 100%")]


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, name string, month string").schema
    return VersionedTable(spark, str(tmp_path / "t"), schema, ("month",))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def make(table, rows):
    return table.spark.createDataFrame(rows, table.schema)


def build(table, rows=ROWS):
    with table.transaction() as tx:
        tx.rebuild(make(table, rows))


def test_rebuild_and_read(table):
    assert rows_of(table.read()) == []
    build(table)
    assert rows_of(table.read()) == sorted(ROWS, key=str)
    for r in ROWS:
        assert rows_of(table.read({"month": r[2]})) == [r]
    build(table, ROWS[:1])
    assert rows_of(table.read()) == ROWS[:1]
    build(table, [])
    assert rows_of(table.read()) == [] and table.commits().count() == 3


def test_merge_keeps_the_warehouse_rule(table):
    build(table, [*ROWS, (1, "same key, other month", "2021-02-01")])
    with table.transaction() as tx:
        tx.merge(make(table, [(1, "new", "2021-01-01"), (1, "twice", "2021-01-01"), (9, "other", "2021-02-01")]), "id", "2021-01-01")
        tx.merge(make(table, [(3, "null month", None)]), "id", None)
        tx.merge(make(table, []), "id", "2021-01-01")
        assert len(rows_of(tx.read())) == 7 and len(rows_of(table.read())) == 5  # readers do not see it yet
    assert rows_of(table.read()) == sorted([(1, "new", "2021-01-01"), (1, "twice", "2021-01-01"), (9, "other", "2021-02-01"), ROWS[1],
                                            (1, "same key, other month", "2021-02-01"), (3, "null month", None), ROWS[3]], key=str)


def test_partition_emptied_by_a_replace(table):
    build(table)
    with table.transaction() as tx:
        tx.replace(make(table, [(8, "z", "2021-03-01")]), [{"month": "x/y: 100%"}, {"month": None}])
    assert rows_of(table.read()) == sorted([*ROWS[:2], (8, "z", "2021-03-01")], key=str)
    with table.transaction() as tx:
        tx.replace_present(make(table, [(7, "y", "2021-01-01")]))
    assert rows_of(table.read()) == sorted([(7, "y", "2021-01-01"), ROWS[1], (8, "z", "2021-03-01")], key=str)


def test_failure_in_a_later_write_changes_nothing(table):
    build(table)
    bad = make(table, [(2, "b2", "2021-02-01")]).withColumn("name", F.when(F.col("id") > 0, F.raise_error(F.lit("bad"))).otherwise("x"))
    with pytest.raises(PySparkException):
        with table.transaction() as tx:
            tx.merge(make(table, [(1, "a2", "2021-01-01")]), "id", "2021-01-01")
            tx.merge(bad, "id", "2021-02-01")
    assert rows_of(table.read()) == sorted(ROWS, key=str)
    # A writer that dies between its writes and the commit leaves files that nothing names.
    lost = table.transaction()
    lost.append(make(table, [(5, "lost", "2021-01-01")]))
    assert rows_of(table.read()) == sorted(ROWS, key=str)
    assert [partition_values(f)["table_version"] for f in table.vacuum()] == lost.staged
    assert rows_of(table.read()) == sorted(ROWS, key=str)


def test_only_touched_partitions_are_rewritten(table):
    build(table)
    before = set(table.paths())
    with table.transaction() as tx:
        tx.merge(make(table, [(1, "a2", "2021-01-01")]), "id", "2021-01-01")
    kept = before & set(table.paths())
    assert len(before) == 4 and {p.rsplit("month=", 1)[1] for p in before - kept} == {"2021-01-01"}


def test_label_and_concurrent_writer(table):
    for _ in range(2):
        with table.transaction("day 1") as tx:
            tx.append(make(table, ROWS[:1]))
    assert rows_of(table.read()) == ROWS[:1] and table.is_committed("day 1") and not table.is_committed("day 2")
    slow = table.transaction()
    slow.append(make(table, ROWS[1:2]))
    build(table, ROWS[2:3])
    with pytest.raises(ConcurrentCommit):
        slow.commit()
    assert rows_of(table.read()) == ROWS[2:3]


def test_upsert_by_partition(table):
    build(table, [*ROWS, (1, "same key", "2021-02-01")])
    with table.transaction() as tx:
        tx.upsert(make(table, [(1, "new", "2021-01-01"), (3, "null", None), (5, "first", "2021-05-01"), (5, "first", "2021-05-01")]), "id")
    assert rows_of(table.read()) == sorted([(1, "new", "2021-01-01"), (1, "same key", "2021-02-01"), ROWS[1], (3, "null", None), ROWS[3],
                                            (5, "first", "2021-05-01"), (5, "first", "2021-05-01")], key=str)


@pytest.mark.parametrize("partitioned", [True, False])
def test_csv_is_parsed_once_and_split(spark, tmp_path, partitioned):
    (tmp_path / "a.csv").write_text("id,name,month\n1,a,m\nx,b,m\n2,c\n3,\"d\n4,e,m\n")
    (tmp_path / "b.csv").write_text("id,name,month\n5,f,n\n")
    schema = spark.createDataFrame([], "id int, name string, month string").schema
    table = VersionedTable(spark, str(tmp_path / "t"), schema, ("month",) if partitioned else ())
    with table.transaction() as tx:
        assert tx.load_csv(str(tmp_path / "b.csv"), load="b") == 0
    with pytest.raises(vcsv.RejectBudgetExceeded):
        with table.transaction() as tx:
            tx.load_csv(str(tmp_path / "a.csv"), max_errors=4, load="refused")
    assert rows_of(table.read()) == [(5, "f", "n")]
    with table.transaction() as tx:
        assert tx.load_csv(str(tmp_path / "a.csv"), max_errors=5, load="a") == 4
    assert rows_of(table.read()) == [(1, "a", "m"), (5, "f", "n")]
    kept = rows_of(table.read_rejects().groupBy("load").agg(F.sum("lines")))
    assert kept == [("a", 4), ("refused", 4)]
