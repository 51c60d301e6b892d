import datetime as dt

from pyspark.sql import functions as F

from loanmart.functions import calendar as cal
from loanmart.functions.columns import (first_match, ladder_at_least, ladder_below, mask_pii,
                                        surrogate_key)


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_mask_kinds(spark):
    df = spark.createDataFrame([("Juana", "ju@x.com", "5491122334455", dt.date(1990, 7, 3), "Rosario")],
                               "name string, email string, phone string, bd date, city string")
    r = df.select(mask_pii("name", "name").alias("n"), mask_pii("email", "email").alias("e"),
                  mask_pii("phone", "phone").alias("p"), mask_pii("bd", "birth_date").alias("b"),
                  mask_pii("city", "other").alias("o")).first()
    assert r.n == "J****"
    assert r.e == "ju***@masked.com"
    assert r.p == "5491****55"
    assert r.b == dt.date(1990, 1, 1)
    assert r.o == "*** MASKED ***"


def test_mask_disabled_and_nulls(spark):
    df = spark.createDataFrame([(None, "a")], "name string, phone string")
    r = df.select(mask_pii("name", "name").alias("n"), mask_pii("phone", "phone").alias("p"),
                  mask_pii("name", "name", enabled=False).alias("raw")).first()
    assert r.n is None  # concat with NULL is NULL
    assert r.p == "a****a"  # short strings: prefix and suffix overlap
    assert r.raw is None


def test_surrogate_key(spark):
    import hashlib
    df = spark.createDataFrame([(7, None)], "a bigint, b bigint")
    r = df.select(surrogate_key("a").alias("k1"), surrogate_key("a", "b").alias("k2"),
                  surrogate_key("b").alias("k3")).first()
    assert r.k1 == hashlib.md5(b"7").hexdigest()
    assert r.k2 == hashlib.md5(b"7-_dbt_utils_surrogate_key_null_").hexdigest()
    assert r.k3 == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()


def test_ladders_fall_through(spark):
    df = spark.createDataFrame([(None,), (10,), (25,), (54,), (55,)], "x int")
    got = df.select("x", ladder_below("x", [(25, "a"), (55, "b")], "c").alias("l")).collect()
    m = {r.x: r.l for r in got}
    assert m == {None: "c", 10: "a", 25: "b", 54: "b", 55: "c"}  # NULL takes the else branch
    got = df.select("x", ladder_at_least("x", [(55, "hi"), (25, "mid")], None).alias("l")).collect()
    m = {r.x: r.l for r in got}
    assert m == {None: None, 10: None, 25: "mid", 54: "mid", 55: "hi"}
    assert one(spark, first_match([(F.lit(False), "x")], "y")) == "y"


def test_sunday_week_matches_strftime_U(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(0, 4018, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", cal.sunday_week_of_year("d").alias("w")).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%U")), d


def test_period_ends_and_year_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 14), dt.date(1990, 12, 31))], "d date, b date")
    r = df.select(cal.quarter_end("d").alias("q"), cal.year_end("d").alias("y"),
                  cal.week_start_monday("d").alias("w"),
                  cal.year_boundaries_between("d", "b").alias("yd")).first()
    assert r.q == dt.date(2024, 3, 31)
    assert r.y == dt.date(2024, 12, 31)
    assert r.w == dt.date(2024, 2, 12)
    assert r.yd == 34  # boundaries crossed, not completed years (33)


def test_easter(spark):
    known = {1995: dt.date(1995, 4, 16), 1999: dt.date(1999, 4, 4), 2021: dt.date(2021, 4, 4),
             2024: dt.date(2024, 3, 31), 2030: dt.date(2030, 4, 21)}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r.y: r.e for r in df.select("y", cal.easter_sunday("y").alias("e")).collect()}
    assert got == known
