"""What one task or one bucket holds stays bounded while tables grow; results stay what they are."""

from pyspark.sql import functions as F

from loanmart import session
from loanmart.operators import assertions as A
from loanmart.operators import keyed_store as K
from loanmart.operators.unique_keys import UniqueKeys
from loanmart.session import scratch_path


def test_buckets_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_ROWS", 50)
    store = K.KeyedStore(spark, scratch_path(spark, "store"), ["id"], buckets=2)
    store.merge(spark.range(300).withColumn("v", F.lit(0)))
    assert store.buckets == 6  # as many as the first rows need
    for step in range(1, 5):
        store.merge(spark.range(200 * step, 200 * step + 300).withColumn("v", F.lit(step)))
        again = K.KeyedStore(spark, store.root, ["id"])
        assert (again.buckets, again.rows) == (store.buckets, store.rows)
        assert store.rows <= 2 * 50 * store.buckets
        values = {r["id"]: r["v"] for r in again.read().collect()}
        assert len(values) == again.read().count() == 200 * step + 300
        assert all(v == min(step, i // 200) for i, v in values.items())
    store.replace(spark.range(10).withColumn("v", F.lit(9)))
    assert store.rows == 10 and store.read().count() == 10


def test_prints_of_many_batches_stay_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_ROWS", 50)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    check = UniqueKeys(spark, scratch_path(spark, "unique"), ["a"], buckets=2)
    parts = {str(k): spark.range(150 * k, 150 * k + 160).select(F.col("id").alias("a")) for k in range(4)}  # 10 keys met again
    for name, batch in parts.items():
        got = check.check(batch, name, lambda names: parts[names[0]])
        k = int(name)
        assert sorted(tuple(r) for r in got.collect()) == [(i, 2) for i in range(150 * k, 150 * k + 10)] * (k > 0)
    assert check.buckets >= 6 and check.rows <= 2 * 50 * check.buckets


def test_uniqueness_is_dealt_by_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    assert session.dealt(spark.range(1000), 1000, "id").rdd.getNumPartitions() == 100
    assert session.dealt(spark.range(1000), 20, "id").rdd.getNumPartitions() == spark.range(1000).rdd.getNumPartitions()
    df = spark.range(500).select((F.col("id") % 450).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("b"), F.lit(1).alias("c"))

    def failures():
        suite = A.Suite()
        t = suite.table("t", df)
        t.unique("a")
        t._add(A.Check("ab", "unique_combination", ("a", "b")))
        t._add(A.Check("b", "unique", ("b",)))
        t._add(A.Check("c", "unique", ("c",)))
        t._add(A.Check("bc", "unique_combination", ("b", "c")))
        return {r["assertion"]: r["failures"] for r in A.failure_report(suite).collect()}

    want = {"unique_t_a": 50, "ab": len([1 for i in range(50) if i % 3 == 0]), "b": 0, "c": 1, "bc": 1}
    assert failures() == want
    monkeypatch.setattr(A.F, "xxhash64", lambda *_: F.lit(7).cast("long"))  # prints that meet by chance
    assert failures() == want
