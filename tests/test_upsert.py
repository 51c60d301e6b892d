"""Keyed merge: idempotent, duplicate keys fail, schema evolution, lookback,
month-partitioned rewrite equal to the logical merge (moves and emptied months)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanmart.operators import upsert as up
from loanmart.session import scratch_path

SCHEMA = "payment_id string, amount int, payment_date date"
D = dt.date


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def state(d, cols=("payment_id", "amount", "payment_date")):
    return sorted(tuple(r[c] for c in cols) for r in d.collect())


def test_update_insert_keep(spark):
    t = df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))])
    b = df(spark, [("b", 20, D(2024, 1, 2)), ("c", 3, D(2024, 1, 3))])
    out = up.upsert(t, b, ["payment_id"])
    assert state(out) == [("a", 1, D(2024, 1, 1)), ("b", 20, D(2024, 1, 2)), ("c", 3, D(2024, 1, 3))]
    # idempotent
    assert state(up.upsert(out, b, ["payment_id"])) == state(out)


def test_duplicate_batch_key_fails(spark):
    t = df(spark, [("a", 1, D(2024, 1, 1))])
    b = df(spark, [("b", 2, D(2024, 1, 2)), ("b", 3, D(2024, 1, 2)), (None, 1, D(2024, 1, 1)),
                   (None, 2, D(2024, 1, 1))])
    with pytest.raises(Exception, match="duplicate key"):
        up.upsert(t, b, ["payment_id"]).collect()
    # NULL keys never match and may repeat
    ok = df(spark, [(None, 1, D(2024, 1, 1)), (None, 2, D(2024, 1, 1))])
    assert len(up.upsert(t, ok, ["payment_id"]).collect()) == 3


def test_schema_evolution_appends_columns(spark):
    t = df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))])
    b = df(spark, [("b", 5, D(2024, 1, 2), "cash")], SCHEMA + ", method string")
    out = up.upsert(t, b, ["payment_id"])
    assert state(out, ("payment_id", "amount", "method")) == [("a", 1, None), ("b", 5, "cash")]


def test_lookback_slice(spark):
    src = df(spark, [("a", 1, D(2024, 1, 1)), ("b", 1, D(2024, 1, 7)), ("c", 1, D(2024, 1, 10))])
    tgt = df(spark, [("x", 1, D(2024, 1, 10))])
    assert [r.payment_id for r in up.lookback_slice(src, tgt, "payment_date", 3).collect()] == ["b", "c"]
    assert up.lookback_slice(src, None, "payment_date", 3).count() == 3
    empty = tgt.where(F.lit(False))
    assert up.lookback_slice(src, empty, "payment_date", 3).count() == 0  # max is NULL


def test_partitioned_merge_matches_logical(spark):
    path = scratch_path(spark, "test_fct")
    b1 = df(spark, [("a", 1, D(2024, 1, 31)), ("b", 2, D(2024, 2, 1)), ("c", 3, D(2024, 2, 15))])
    up.merge_into_partitions(spark, path, b1, ["payment_id"], "payment_date", "m", ("amount",), first_run=True)
    # 'a' moves to February (January becomes empty), 'b' changes, 'd' is new in March
    b2 = df(spark, [("a", 10, D(2024, 2, 2)), ("b", 20, D(2024, 2, 1)), ("d", 4, D(2024, 3, 1))])
    up.merge_into_partitions(spark, path, b2, ["payment_id"], "payment_date", "m", ("amount",))
    got = spark.read.parquet(path)
    want = up.upsert(b1, b2, ["payment_id"])
    assert state(got) == state(want)
    months = {str(r.m) for r in got.select("m").distinct().collect()}
    assert months == {"2024-02-01", "2024-03-01"}
    with pytest.raises(Exception, match="duplicate key"):
        up.merge_into_partitions(spark, path, df(spark, [("z", 1, D(2024, 3, 2))] * 2), ["payment_id"],
                                 "payment_date", "m")


def test_null_month_keeps_its_rows(spark):
    path = scratch_path(spark, "null_month")
    up.merge_into_partitions(spark, path, df(spark, [("a", 1, None), ("b", 2, D(2024, 1, 2))]), ["payment_id"], "payment_date", first_run=True)
    up.merge_into_partitions(spark, path, df(spark, [("c", 3, None), ("b", 4, None)]), ["payment_id"], "payment_date")
    assert state(spark.read.parquet(path)) == [("a", 1, None), ("b", 4, None), ("c", 3, None)]
    up.merge_into_partitions(spark, path, df(spark, [("a", 5, D(2024, 1, 3)), ("b", 4, D(2024, 1, 3)), ("c", 3, D(2024, 2, 3))]), ["payment_id"], "payment_date")
    assert state(spark.read.parquet(path)) == [("a", 5, D(2024, 1, 3)), ("b", 4, D(2024, 1, 3)), ("c", 3, D(2024, 2, 3))]


def test_an_older_version_replaces_nothing(spark):
    schema = SCHEMA + ", delivered_at date"
    path = scratch_path(spark, "versions")

    def merge(*rows, first=False):
        up.merge_into_partitions(spark, path, df(spark, list(rows), schema), ["payment_id"], "payment_date", first_run=first, version_col="delivered_at")

    merge(("a", 99, D(2024, 1, 5), D(2024, 2, 2)), first=True)
    merge(("a", 1, D(2024, 1, 5), D(2024, 2, 1)), ("b", 2, D(2024, 1, 6), D(2024, 2, 1)))
    assert state(spark.read.parquet(path)) == [("a", 99, D(2024, 1, 5)), ("b", 2, D(2024, 1, 6))]
    merge(("a", 7, D(2024, 3, 5), D(2024, 2, 3)))
    assert state(spark.read.parquet(path)) == [("a", 7, D(2024, 3, 5)), ("b", 2, D(2024, 1, 6))]
    merge(("a", 8, D(2024, 1, 5), D(2024, 1, 1)))
    assert state(spark.read.parquet(path)) == [("a", 7, D(2024, 3, 5)), ("b", 2, D(2024, 1, 6))]
