"""Jobs in passes and shuffles given back: every row once, the same tables, little on disk at a time."""

import pytest
from pyspark.sql import functions as F

from vaxmart.sources import csv as vcsv
from vaxmart.sources import passes
from vaxmart.sources.tables import land_partitioned


@pytest.fixture
def small_passes(monkeypatch):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)


def shuffle_files(spark):
    """Shuffle files that the session holds."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_passes_hold_each_row_once(spark, tmp_path, small_passes):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 97).cast("string").alias("k"), "id",
        F.when(F.col("id") % 10 != 0, F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id"))).alias("n"),
        F.when(F.col("id") % 7 != 0, F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 50).cast("int"))).alias("d"))
    rows.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for parts in (passes.hash_passes(df, ["k"]), passes.range_passes(df, "d"), passes.range_passes(df, "n")):
        assert 1 < len(parts) <= passes.MOST_PASSES
        assert sorted(r.id for p in parts for r in p.collect()) == list(range(2000))
    by_key = [{r.k for r in p.collect()} for p in passes.hash_passes(df, ["k"])]
    assert sum(map(len, by_key)) == len(set().union(*by_key))
    dates = [[r.d for r in p.collect()] for p in passes.range_passes(df, "d")]
    assert None in dates[0] and all(max(filter(None, a)) < min(b) for a, b in zip(dates, dates[1:]))
    # One value, nulls alone and no rows at all are one pass; so is an input whose size is not known, and no key.
    for one in (df.select(F.lit(1).alias("n")), df.select(F.lit(None).cast("int").alias("n")), df.where("id < 0")):
        assert len(passes.range_passes(one, "n")) == 1
    assert passes.pass_count(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "n int")) == 1
    assert len(passes.hash_passes(df, [])) == 1


def test_a_pass_joins_its_own_rows_only(spark, small_passes):
    from tests.conftest import SF_SMALL
    from vaxmart.sources.fixtures import raw_vaccinations

    parts = passes.hash_passes(raw_vaccinations(spark, SF_SMALL), ["paciente_id"])
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "xxhash64" in line]
    assert len(parts) == passes.MOST_PASSES and any("l_orderkey" in f for f in filters) and any("o_orderkey" in f for f in filters)


def test_landing_in_passes(spark, tmp_path, small_passes):
    rows = spark.range(3000).repartition(3).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 100).cast("string").alias("person"), F.col("id").cast("string").alias("id"),
        *[F.lit(f"text {i}").alias(f"t{i}") for i in range(8)], F.concat(F.lit("f"), F.col("id") % 5).alias("p"))
    rows.write.parquet(str(tmp_path / "rows"))
    df, base = spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "landing")
    before = shuffle_files(spark)
    land_partitioned(df, base, partition_by=["p"], passes_by=["person"])
    assert not shuffle_files(spark) - before  # nothing is left for the garbage collector
    back = vcsv.load_csv(spark, vcsv.landing_glob(base, ["p"]), df.schema)
    assert sorted_rows(back) == sorted_rows(df)
    with pytest.raises(ValueError, match="passes"):
        land_partitioned(df, base, mode="replace", partition_by=["p"], passes_by=["person"])


def test_setting_of_the_session_comes_back(spark):
    key = passes._CLEANUP
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), passes.released_shuffles(spark), passes.released_shuffles(spark):
        raise ValueError
    assert spark.conf.get(key, None) == before
    with passes.released_shuffles(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        first = sorted_rows(df)
    assert sorted_rows(df) == first  # runs again without its files


def test_star_in_passes_is_the_star(spark, tmp_path, monkeypatch):
    from tests.conftest import SF_SMALL
    from vaxmart.plans import pipeline
    from vaxmart.sources.fixtures import raw_population, raw_vaccinations
    from vaxmart.sources.named import STAR_TABLES

    raw, population = raw_vaccinations(spark, SF_SMALL), raw_population(spark, SF_SMALL)
    report = pipeline.run(spark, raw, population, str(tmp_path / "one"), expected_states=5)
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    before = shuffle_files(spark)
    assert pipeline.run(spark, raw, population, str(tmp_path / "more"), expected_states=5, passes_by=["paciente_id"]) == report
    assert not shuffle_files(spark) - before
    for table in (*STAR_TABLES, "staging_vaccinations"):
        one, more = (spark.read.parquet(str(tmp_path / w / table)) for w in ("one", "more"))
        assert more.schema == one.schema and more.count() == one.count()
        assert more.exceptAll(one.select(*more.columns)).isEmpty()
    # The fact's files still hold ranges of dates.
    dates = spark.read.parquet(str(tmp_path / "more" / "fact_vaccinations")).groupBy(F.input_file_name()).agg(
        F.min("vaccination_date").alias("low"), F.max("vaccination_date").alias("high")).orderBy("low", "high").collect()
    assert len(dates) >= passes.MOST_PASSES and all(a.high <= b.low for a, b in zip(dates, dates[1:]))


def test_keys_of_a_uniqueness_check_cross_the_join_as_bytes(spark):
    from vaxmart.operators import quality

    keys = [("0" * 32,), ("0" * 32,), ("F" * 32,), ("F" * 32,), ("f" * 32,), (None,), (None,), ("x",)]
    found = quality.duplicate_groups(spark.createDataFrame(keys, "vaccination_sk string"), ["vaccination_sk"])
    assert sorted_rows(found) == sorted([("0" * 32, 2), ("F" * 32, 2), (None, 2)], key=repr)
    assert "unhex" in found._jdf.queryExecution().executedPlan().toString()


def test_a_batch_of_a_stream_gives_its_shuffles_back(spark, tmp_path):
    from vaxmart.streaming.merge_stream import merge_batch_into

    rows = spark.range(900).repartition(3).select(
        F.col("id").cast("string").alias("pk"), *[F.lit(f"text {i}").alias(f"t{i}") for i in range(8)], F.concat(F.lit("m"), F.col("id") % 4).alias("m"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    rows.limit(0).write.partitionBy("m").parquet(str(tmp_path / "t"))
    before = shuffle_files(spark)
    for part in (rows.where("pk < 600"), rows.where("pk > 300 AND pk % 4 < 2")):
        merge_batch_into(spark, part, str(tmp_path / "t"), "pk", "m", rows.schema)
    assert not shuffle_files(spark) - before
    assert sorted_rows(spark.read.schema(rows.schema).parquet(str(tmp_path / "t")).select(*rows.columns)) == sorted_rows(
        rows.where("pk < 600 OR pk > 300 AND pk % 4 < 2"))


def test_buckets_in_passes(spark, tmp_path, small_passes):
    from vaxmart.sources import layouts, named

    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.md5((F.col("id") % 97).cast("string"))).alias("patient_sk"), "id")
    rows.write.parquet(str(tmp_path / "rows"))
    fact = spark.read.parquet(str(tmp_path / "rows"))
    people = fact.select("patient_sk").distinct().withColumn("v", F.length("patient_sk"))
    people.write.parquet(str(tmp_path / "people"))
    named.use_database(spark, "pass_tests")
    try:
        for _ in range(2):  # the second time in place of the first
            before = shuffle_files(spark)
            for df, name in ((fact, "fact"), (spark.read.parquet(str(tmp_path / "people")), "people")):
                layouts.write_bucketed(df, f"pass_tests.{name}", str(tmp_path / f"{name}-buckets"), "patient_sk", 8, hot_keys=["hot"])
            assert not shuffle_files(spark) - before
        table = spark.table("pass_tests.fact")
        assert sorted_rows(table.unionByName(spark.table("pass_tests.fact__hot"))) == sorted_rows(fact)
        files = table.groupBy(F.input_file_name().alias("f")).agg(F.collect_set(F.pmod(F.hash("patient_sk"), F.lit(8))).alias("buckets")).collect()
        assert sorted(b for f in files for b in f.buckets) == list(range(8)) and len(files) == 8  # a bucket is one file still
        joined = layouts.join_bucketed(spark, "pass_tests.fact", "pass_tests.people", "patient_sk", hot_keys=["hot"])
        assert sorted_rows(joined.select("patient_sk", "id", "v")) == sorted_rows(fact.join(people, "patient_sk").select("patient_sk", "id", "v"))
        assert "hashpartitioning(patient_sk" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE IF EXISTS pass_tests CASCADE")


def test_interleaved_order_in_passes(spark, tmp_path, monkeypatch):
    from vaxmart.sources import layouts

    rows = spark.range(20_000).select(F.when(F.col("id") % 40 != 0, F.col("id") * 7919 % 1000).alias("a"), F.md5(F.col("id").cast("string")).alias("b"), "id")
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    layouts.write_interleaved(df, str(tmp_path / "one"), ["a", "b"], 16, ["id"])
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    before = shuffle_files(spark)
    layouts.write_interleaved(df, str(tmp_path / "more"), ["a", "b"], 16, ["id"])
    assert not shuffle_files(spark) - before
    one, more = (spark.read.parquet(str(tmp_path / w)) for w in ("one", "more"))
    assert sorted_rows(more) == sorted_rows(df)
    # Files are ranges of the same key: its ranges do not overlap, and each column is narrowed as before.
    keyed = layouts.interleaved(more, ["a", "b"], cuts=layouts.quantiles(df, ["a", "b"], 8)).groupBy(F.input_file_name().alias("f"))
    ranges = keyed.agg(F.min("_z").alias("low"), F.max("_z").alias("high")).orderBy("low", "high").collect()
    assert 12 <= len(ranges) <= 20 and all(x.high <= y.low for x, y in zip(ranges, ranges[1:]))

    def files(t, where):
        return t.where(where).select(F.input_file_name()).distinct().count()

    for where in ("a >= 100 AND a < 200", "b >= '10' AND b < '30'"):
        assert files(more, where) <= files(one, where) + 2
    # One value in all rows: one pass, all files.
    same = df.select(F.lit(1).alias("a"), F.lit("x").alias("b"), "id")
    layouts.write_interleaved(same, str(tmp_path / "same"), ["a", "b"], 4, ["id"])
    assert spark.read.parquet(str(tmp_path / "same")).count() == 20_000
    assert len(list((tmp_path / "same").glob("*.parquet"))) == 4
    layouts.write_interleaved(df.where("id < 0"), str(tmp_path / "none"), ["a", "b"], 4, ["id"])
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_table_with_bloom_filters_is_compressed_with_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    from vaxmart.sources import layouts

    layouts.write_with_bloom_filters(spark.range(100).select(F.md5(F.col("id").cast("string")).alias("k")), str(tmp_path / "b"), {"k": 100})
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in (tmp_path / "b").glob("*.parquet")} == {"ZSTD"}
