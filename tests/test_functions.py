"""Scalar building blocks: keys, calendar, weeks, month buckets, categories."""

import datetime as dt

from pyspark.sql import functions as F

from vaxmart.functions import (
    calendar_fields,
    load_mode,
    normalize_category,
    surrogate_key,
    week_start,
    weeks_between,
    year_month,
)
from vaxmart.functions.temporal import load_mode_for
from vaxmart.operators.dims import crop_city_code

EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def test_surrogate_key_nulls_and_collisions(spark):
    df = spark.createDataFrame(
        [("8", "51", "x"), ("85", "1", "x"), (None, None, None), ("a", None, "b")], "a string, b string, c string"
    )
    rows = df.select(surrogate_key("a", "b", "c").alias("k"), surrogate_key("a", "b", "c", separator="|").alias("s"))
    rows = rows.collect()
    assert rows[0].k == rows[1].k  # no separator: the warehouse's collision
    assert rows[0].s != rows[1].s
    assert rows[2].k == EMPTY_MD5  # all inputs missing -> md5('')
    import hashlib

    assert rows[3].k == hashlib.md5(b"ab").hexdigest()


def test_calendar_fields_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 4),), (None,)], "d date")
    out = df.select(*[c.alias(n) for n, c in calendar_fields("d").items()]).collect()
    assert (out[0].day, out[0].week, out[0].month, out[0].year, out[0].weekday) == (3, 53, 1, 2021, 0)
    assert (out[1].week, out[1].weekday) == (1, 1)
    assert out[2].week is None


def test_weeks_between_counts_monday_boundaries(spark):
    rows = [
        (dt.date(2021, 1, 3), dt.date(2021, 1, 4), 1),  # Sunday -> Monday
        (dt.date(2021, 1, 4), dt.date(2021, 1, 10), 0),  # Monday -> next Sunday
        (dt.date(2021, 1, 4), dt.date(2021, 2, 8), 5),
        (dt.date(2021, 1, 10), dt.date(2021, 2, 8), 5),
    ]
    df = spark.createDataFrame(rows, "a date, b date, want int")
    got = df.select(weeks_between("a", "b").alias("w"), "want", week_start("a").alias("ws")).collect()
    assert [r.w for r in got] == [r.want for r in got]
    assert got[0].ws == dt.date(2020, 12, 28)


def test_month_end_load_mode(spark):
    days = [dt.date(2021, 2, 28), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2021, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.m for r in df.select(load_mode("d").alias("m")).collect()]
    assert got == ["replace", "append", "replace", "replace"]
    assert [load_mode_for(d) for d in days] == got


def test_year_month_bucket(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 7, 18, 13, 5),)], "t timestamp_ntz")
    assert df.select(year_month("t")).first()[0] == "2021-07-01"


def test_city_code_crop(spark):
    df = spark.createDataFrame([(1200013,), (None,)], "c int")
    assert [r[0] for r in df.select(crop_city_code("c")).collect()] == ["120001", None]


def test_normalize_category_first_rule_wins(spark):
    names = ["Coronavac-Sinovac/Butantan", "Vacina Covishield", "Oxford/AstraZeneca", "BioNTech/Pfizer",
             "Janssen-Cilag", "Outra", None, "pfizer BUTANTAN"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(normalize_category("n")).collect()]
    assert got == ["Coronavac", "AstraZeneca", "AstraZeneca", "Pfizer", "Janssen", "Outra", None, "Coronavac"]
    assert df.select(normalize_category(F.col("n"), [])).count() == len(names)
