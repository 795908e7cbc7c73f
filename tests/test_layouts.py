"""Named tables, buckets, interleaved order, Bloom filters, one-scan checks, contract documents, SQL analyses: plans and edges."""

import json

import pytest
from pyspark.sql import functions as F

from vaxmart.operators import quality
from vaxmart.sources import contracts, layouts, named


@pytest.fixture
def database(spark):
    named.use_database(spark, "layout_tests")
    yield "layout_tests"
    spark.sql("DROP DATABASE IF EXISTS layout_tests CASCADE")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_named_table_life(spark, database, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y/z"), (3, "c", None)], "id int, `odd name` string, part string")
    name = f"{database}.things"
    assert named.create_table(spark, name, rows.schema, str(tmp_path / "t"), ["part"])
    assert not named.create_table(spark, name, rows.schema, str(tmp_path / "t"), ["part"])
    assert named.load_if_empty(spark, name, rows) and not named.load_if_empty(spark, name, rows)
    assert sorted(r.id for r in spark.sql(f"SELECT * FROM {name} WHERE part = 'y/z' OR part IS NULL").collect()) == [2, 3]
    rows.where("id = 1").withColumn("id", F.lit(4)).write.mode("append").partitionBy("part").parquet(str(tmp_path / "t"))
    rows.where("id = 1").select(F.lit(5).alias("id"), "`odd name`", F.lit("new").alias("part")).write.mode("append").partitionBy("part").parquet(
        str(tmp_path / "t"))
    named.refresh(spark, name)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
    named.create_view(spark, f"{database}.some", f"SELECT id FROM {name} WHERE id > 3")
    assert spark.table(f"{database}.some").count() == 2
    bad = rows.withColumn("odd name", F.when(F.col("id") > 0, F.raise_error(F.lit("bad"))).otherwise("x"))
    with pytest.raises(Exception, match="bad"):
        named.rebuild(spark, name, bad, str(tmp_path / "t2"), ["part"])
    assert spark.table(name).count() == 5  # the name keeps the old rows
    named.rebuild(spark, name, rows, str(tmp_path / "t3"), ["part"])
    assert spark.table(name).count() == 3


def test_buckets_join_without_exchange(spark, database, tmp_path):
    fact = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id")
    dim = fact.select("k").distinct().withColumn("v", F.length("k"))
    plain = {tuple(r) for r in fact.join(dim, "k").select("k", "id", "v").collect()}
    for hot in ([], ["hot"]):
        layouts.write_bucketed(fact, f"{database}.fact", str(tmp_path / f"f{len(hot)}"), "k", 4, hot_keys=hot)
        layouts.write_bucketed(dim, f"{database}.dim", str(tmp_path / f"d{len(hot)}"), "k", 4, hot_keys=hot)
        joined = layouts.join_bucketed(spark, f"{database}.fact", f"{database}.dim", "k", hot_keys=hot)
        plan = executed(joined)
        assert "SortMergeJoin" in plan and "hashpartitioning(k" not in plan
        assert {tuple(r) for r in joined.select("k", "id", "v").collect()} == plain
    assert "hashpartitioning(k" not in executed(spark.table(f"{database}.fact").groupBy("k").count())
    # The hot key's rows are not in one bucket file.
    assert spark.table(f"{database}.fact__hot").count() == 1334 and spark.table(f"{database}.fact").where("k = 'hot'").isEmpty()


def test_interleaved_order_narrows_both_columns(spark, tmp_path):
    n = 40_000
    rows = spark.range(n).select((F.col("id") * 7919 % 1000).alias("a"), F.md5(F.col("id").cast("string")).alias("b"), "id").repartition(8)
    layouts.write_interleaved(rows, str(tmp_path / "z"), ["a", "b"], 16, ["id"])
    layouts.interleaved(rows, ["a"], bits=8).repartitionByRange(16, "a", "id").drop("_z").write.parquet(str(tmp_path / "a"))
    read = lambda p: spark.read.parquet(str(tmp_path / p))
    def files(p, low, high, column):
        found = read(p).groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        return found.where((F.col("hi") >= low) & (F.col("lo") < high)).count()

    assert read("z").count() == n and {tuple(r) for r in read("z").where("id < 50").collect()} == {tuple(r) for r in rows.where("id < 50").collect()}
    by_b = files("z", "10", "30", "b")
    assert by_b <= 10 and files("a", "10", "30", "b") == 16  # an order on the other column alone narrows nothing
    assert files("z", 100, 200, "a") <= 10


def test_interleaved_ranks(spark):
    rows = spark.createDataFrame([(None, None), (1, "a"), (2, "b"), (2, "b"), (3, None), (None, "zz")], "x int, y string")
    got = layouts.interleaved(rows, ["x", "y"], bits=2).collect()
    keys = {(r.x, r.y): r._z for r in got}
    assert len(got) == 6 and keys[None, None] == 0 and keys[1, "a"] < keys[2, "b"] and keys[None, "zz"] > 0
    assert layouts.interleaved(rows.where("false"), ["x", "y"], bits=2).count() == 0


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = spark.range(120_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(6, "id")
    rows.write.parquet(str(tmp_path / "plain"))
    layouts.write_with_bloom_filters(rows, str(tmp_path / "bloom"), {"k": 20_000})
    key = rows.where("id = 77").first()["k"]
    read = {}
    for kind in ("plain", "bloom"):
        found = spark.read.parquet(str(tmp_path / kind)).where(F.col("k") == key)
        assert [r.id for r in found.collect()] == [77]
        read[kind] = layouts.scanned_rows(found)
    assert read["bloom"] < read["plain"] / 2


def test_fact_checks_scan_once(spark, tmp_path):
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3), ("c", None), ("d", 9)], "k string, d int")
    fact.write.parquet(str(tmp_path / "f"))
    dim = spark.createDataFrame([(1, "x"), (2, None), (3, "x"), (4, "unused")], "d int, v string")
    report = quality.check_fact(spark.read.parquet(str(tmp_path / "f")), dim, "k", "d", "v", 2)
    assert {r["check"]: (r["observed"], r["passed"]) for r in report.collect()} == {
        "fact_unique_k": (1, False), "fact_not_null_k": (1, False), "fact_distinct_v": (2, True)}
    assert executed(report).count("FileScan parquet") == 1 or executed(report).split("== Initial Plan")[0].count("FileScan parquet") == 1
    empty = quality.check_fact(spark.read.parquet(str(tmp_path / "f")).where("false"), dim, "k", "d", "v", 0)
    assert all(r["observed"] == 0 and r["passed"] for r in empty.collect())


def test_contract_documents(spark, tmp_path):
    document = {"streams": [{"tap_stream_id": "s", "key_properties": ["id"], "schema": {"additionalProperties": False, "properties": {
        "id": {"type": "integer"}, "t": {"type": ["null", "string"]}, "at": {"type": ["string"], "format": "date-time"}, "gone": {"type": ["number"]}}},
        "metadata": [{"breadcrumb": [], "metadata": {"selected": True}}, {"breadcrumb": ["properties", "gone"], "metadata": {"selected": False}}]}]}
    (tmp_path / "c.json").write_text(json.dumps(document, indent=2))
    contract = contracts.read_contract(spark, str(tmp_path / "c.json"), "s")
    assert contract.schema.simpleString() == "struct<id:int,t:string,at:timestamp>" and contract.nullable == {"t"}
    assert contract.keys == ("id",) and contract.closed
    rows = spark.createDataFrame([(1, None, None), (2, "x", None)], "id int, t string, at timestamp").withColumn("more", F.lit(1))
    assert contract.conform(rows).columns == ["id", "t", "at"]
    assert {r["column_name"]: r["passed"] for r in contract.report(rows).collect()} == {"id": True, "t": True, "at": False, "more": False}
    for text in ("{}", "[]", "no json", json.dumps({"streams": [{"stream": "s", "schema": {"properties": {"x": {"type": ["object"]}}}}]})):
        with pytest.raises(contracts.ContractError):
            contracts.parse_contract(text, "s")


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_cross_a_shuffle_as_one_line(spark):
    from vaxmart.sources.tables import rebalanced

    rows = [("a", None, "", "\x1e", "b\x1fc", '\n,"', "é漢", " x ", "\x1e\x1e", 1, "q", "m"), (None,) * 12, ("",) * 9 + (2, "", ""),
            ("a",) * 9 + (3, "b", "m"), (None, "\x1e", "a\x1f") + ("z",) * 6 + (4, "c", "n"), ("\x1ea", None) + ("z",) * 7 + (5, None, "n")]
    df = spark.createDataFrame(rows, ", ".join(f"t{i} string" for i in range(9)) + ", n int, `odd ``x` string, p string")
    dealt = rebalanced(df, ["p"])
    assert dealt.schema == df.schema and sorted(map(tuple, dealt.collect()), key=repr) == sorted(rows, key=repr)
    assert "_line" in explained(dealt)


def test_digests_cross_a_shuffle_as_bytes(spark, database, tmp_path):
    from vaxmart.sources.tables import write_layout

    rows = [("0" * 32, "A" * 32, 1), ("0123456789abcdef" * 2, None, 2), (None, "zz", 3), ("", "0" * 32 + "\n", 4), ("abc", "0" * 31 + "A", 5)]
    df = spark.createDataFrame(rows, "vaccination_sk string, patient_sk string, n int")
    dealt = write_layout(df, range_by=["vaccination_sk"], sort_by=["vaccination_sk"], num_partitions=3)
    found = [tuple(r) for r in dealt.collect()]
    assert dealt.columns == df.columns and found == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "")) and "unhex" in explained(dealt)
    layouts.write_bucketed(df, f"{database}.keys", str(tmp_path / "k"), "vaccination_sk", 2)
    assert sorted(map(tuple, spark.table(f"{database}.keys").collect()), key=repr) == sorted(rows, key=repr)
    files = [p for p in (tmp_path / "k").iterdir() if p.suffix == ".parquet"]
    assert len(files) <= 2  # each bucket is still one file
    layouts.write_interleaved(df, str(tmp_path / "z"), ["n"], 2, ["vaccination_sk"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "z")).collect()), key=repr) == sorted(rows, key=repr)


def test_keys_of_a_fact_check_do_not_meet_in_one_task(spark):
    fact = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("d"))
    dim = spark.createDataFrame([(0, "x"), (1, "y"), (2, "y")], "d long, v string")
    report = quality.check_fact(fact, dim, "k", "d", "v", 2)
    assert all(r["passed"] for r in report.collect())
    plan = explained(report).split("Initial Plan")[-1]
    join = plan.index("LeftOuter")
    # Before the join, groups are summed up by (set, dimension key).
    assert "_repeated" in plan[join:] and "partial_max(" in plan[join:]


def test_landed_rows_cross_the_shuffle_in_blocks(spark, tmp_path):
    """Every value comes back, odd and null ones and null folders too; rows of many folders share a shuffle row each."""
    from vaxmart.sources import blocks
    from vaxmart.sources.tables import land_partitioned, open_files, rebalanced_in_blocks

    texts = [F.when(F.col("id") % 11 != i, F.concat(F.lit(f"text {i} of "), F.col("id") % (i + 5))).alias(f"t{i}") for i in range(9)]
    odd = [F.when(F.col("id") % 50 == 0, "a\x1fb").when(F.col("id") % 50 == 1, "\x1e").when(F.col("id") % 50 == 2, "").otherwise("é").alias("odd"),
           F.when(F.col("id") % 7 != 0, F.concat(F.lit("f"), F.col("id") % 7)).alias("p"), (F.col("id") % 3).cast("int").alias("q"),
           F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int")).alias("d"), (F.col("id") / 7).cast("decimal(20,9)").alias("x"),
           F.col("id").cast("timestamp").alias("at")]
    df = spark.range(5000).repartition(2).select("id", *texts, *odd)
    dealt = rebalanced_in_blocks(df, ["p", "q"])
    assert sorted(map(tuple, dealt.collect()), key=lambda r: r[0]) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
    assert "_block" in executed(dealt) and "_block" not in executed(rebalanced_in_blocks(df.select("id", "p", "t0"), ["p"]))
    assert "_block" not in executed(rebalanced_in_blocks(df.withColumn("a", F.array("id")), ["p"]))  # a type that blocks do not hold
    crossing = []
    blocks.in_blocks(df, ["p", "q"], lambda rows: crossing.append(rows) or rows)
    n, size = crossing[0].agg(F.count(F.lit(1)), F.sum(F.length("_block"))).first()
    assert n <= 2 * 7 * 3 and size < 5000 * 60

    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with pytest.raises(ValueError), open_files(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    folders = df.withColumn("p", F.concat(F.lit("f"), F.col("id") % 150))  # more than a task keeps open
    land_partitioned(folders.where("odd != ''").coalesce(1), str(tmp_path / "l"), partition_by=["p"])
    from vaxmart.sources import csv as vcsv
    back = vcsv.load_csv(spark, vcsv.landing_glob(str(tmp_path / "l"), ["p"]), folders.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == sorted(map(tuple, folders.where("odd != ''").collect()), key=lambda r: r[0])


def test_gathered_rows_are_bounded_by_bytes(spark):
    import pyarrow as pa

    from vaxmart.sources.blocks import gathered, make_blocks, open_blocks

    batches = [pa.RecordBatch.from_pydict({"k": [str(j % 2) for j in range(10)], "v": ["x" * 100] * 10}) for _ in range(9)]
    assert [t.num_rows for t in gathered(iter(batches), 3000)] == [30, 30, 30]
    made = list(make_blocks(iter(batches), ["k"]))
    assert sum(b.num_rows for b in made) == 2
    assert sorted(v for b in open_blocks(iter(made)) for v in b["k"].to_pylist()) == ["0"] * 45 + ["1"] * 45


def test_loaded_table_is_compressed_with_zstd(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import types as T

    from vaxmart.sources import csv as vcsv

    (tmp_path / "a.csv").write_text("id,name\n1,a\n2,b\n")
    schema = T.StructType().add("id", T.IntegerType()).add("name", T.StringType())
    vcsv.load_csv_to_table(spark, str(tmp_path / "a.csv"), schema, str(tmp_path / "t"))
    files = glob.glob(str(tmp_path / "t" / "*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
