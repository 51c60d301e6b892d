"""The bucketed table: merges equal the logical upsert, write their batch only, shuffle no
stored part, and are published as a whole."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from loanmart.operators import upsert as up
from loanmart.operators.keyed_store import KeyedStore
from loanmart.operators.published import published
from loanmart.session import scratch_path

SCHEMA = "payment_id string, amount int, payment_date date"
D = dt.date


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def state(d, cols=("payment_id", "amount", "payment_date")):
    return sorted((tuple(r[c] for c in cols) for r in d.collect()), key=str)


def store(spark, root=None, **how):
    return KeyedStore(spark, root or scratch_path(spark, "store"), ["payment_id"], **{"buckets": 4, **how})


def folder_bytes(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def test_merges_equal_the_upsert(spark):
    s = store(spark, max_parts=3)
    assert not s.exists() and s.read() is None and s.max_value("amount") is None
    t = None
    for k in range(6):
        batch = df(spark, [(f"p{i}", 100 * k + i, D(2024, 1, 1 + k)) for i in range(k, 20, k + 1)] + [(f"new{k}", k, None)])
        s.merge(batch)
        t = batch if t is None else up.upsert(t, batch, ["payment_id"])
        assert state(s.read()) == state(t) and len(s.parts) <= 3
    assert s.max_value("payment_date") == t.agg(F.max("payment_date")).first()[0]
    s.compact()
    assert len(s.parts) == 1 and state(s.read()) == state(t)
    s.replace(df(spark, [("only", 1, None)]))
    assert state(s.read()) == [("only", 1, None)]


def test_null_and_duplicate_keys(spark):
    s = store(spark)
    s.merge(df(spark, [(None, 1, D(2024, 1, 1)), (None, 2, D(2024, 1, 1)), ("a", 1, None)]))
    with pytest.raises(Exception, match="duplicate key"):
        s.merge(df(spark, [("b", 2, None), ("b", 3, None)]))
    assert len(s.parts) == 1 and published(spark, s.root)[0] == 1  # nothing was published
    s.merge(df(spark, [(None, 3, None), ("a", 5, None)]))
    assert state(s.read()) == [("a", 5, None), (None, 1, D(2024, 1, 1)), (None, 2, D(2024, 1, 1)), (None, 3, None)]
    s.merge(df(spark, []))
    assert s.read().count() == 4


def test_schema_evolution(spark):
    s = store(spark)
    s.merge(df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))]))
    s.merge(df(spark, [("b", 5, D(2024, 1, 2), "cash")], SCHEMA + ", method string"))
    s.merge(df(spark, [("c", 6, None)]))
    want = [("a", 1, None), ("b", 5, "cash"), ("c", 6, None)]
    assert s.read().columns == ["payment_id", "amount", "payment_date", "method"]
    assert state(s.read(), ("payment_id", "amount", "method")) == want
    s.compact()
    assert state(s.read(), ("payment_id", "amount", "method")) == want


def test_another_session_reads_the_published_state(spark):
    s = store(spark)
    s.merge(df(spark, [("a", 1, None)]))
    early = store(spark, s.root, buckets=99)
    s.merge(df(spark, [("a", 2, None)]))
    assert early.buckets == 4 and state(early.read()) == [("a", 1, None)]  # the state it opened
    other = spark.newSession()
    for name in [r.tableName for r in other.sql(f"show tables in `{s._database()}`").collect()]:
        other.sql(f"drop table `{s._database()}`.`{name}`")  # as if its catalog had never seen them
    assert state(KeyedStore(other, s.root, ["payment_id"]).read()) == [("a", 2, None)]
    with pytest.raises(ValueError):
        KeyedStore(spark, s.root, ["amount"])


def test_a_merge_writes_its_batch_and_shuffles_no_part(spark):
    s = store(spark, buckets=8)
    s.merge(spark.range(200_000).select(F.col("id").cast("string").alias("payment_id"), F.col("id").cast("int").alias("amount"), F.lit(D(2024, 1, 1)).alias("payment_date")))
    before = folder_bytes(s.root)
    s.merge(spark.range(199_000, 201_000).select(F.col("id").cast("string").alias("payment_id"), F.lit(-1).alias("amount"), F.lit(D(2024, 1, 2)).alias("payment_date")))
    assert folder_bytes(s.root) - before < before / 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = s.read()
        assert rows.count() == 201_000 and rows.where("amount = -1").count() == 2000
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert re.search(r"SelectedBucketsCount: 8 out of 8", plan) or "Bucketed: true" in plan


def test_payment_runs_shuffle_no_stored_part(spark):
    from conftest import SF_SMALL
    from loanmart import registry as R
    from loanmart.plans import facts
    root = scratch_path(spark, "runs")
    feeds = R._models(spark, SF_SMALL).payment_feeds((3, 4, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = facts.incremental_runs_stored(spark, root, feeds)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    sizes = [folder_bytes(f"{root}/parts/{p}") for p in KeyedStore(spark, root, ["payment_id"]).parts]
    assert len(sizes) == 3 and max(sizes[1:]) < sum(sizes) / 2
