"""The month-partitioned table: merges equal the logical upsert, are published as a whole, and
its clustering rules out files for predicates on each cluster column."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanmart.operators import upsert as up
from loanmart.operators.clustering import border_aggregates, interleaved
from loanmart.operators.partition_store import PartitionStore
from loanmart.operators.published import published
from loanmart.session import scratch_path

SCHEMA = "payment_id string, amount int, payment_date date"
D = dt.date


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def state(d, cols=("payment_id", "amount", "payment_date")):
    return sorted((tuple(r[c] for c in cols) for r in d.collect()), key=str)


def store(spark, root=None, **how):
    return PartitionStore(spark, root or scratch_path(spark, "months"), ["payment_id"], "payment_date", "m", ("amount",), **how)


@pytest.mark.parametrize("bound", [0, 1000])
def test_merges_equal_the_upsert(spark, bound):
    s, t = store(spark, max_broadcast_rows=bound), None
    steps = [[("a", 1, D(2024, 1, 31)), ("b", 2, D(2024, 2, 1)), ("c", 3, None)],
             [("a", 10, D(2024, 2, 2)), ("d", 4, D(2024, 3, 1))],  # January is emptied
             [("c", 30, D(2024, 3, 5)), ("b", 2, None)],  # the undated month changes hands
             [],
             [("a", 5, D(2023, 12, 1)), ("d", 6, D(2023, 12, 1)), ("c", 7, D(2023, 12, 1)), ("b", 8, D(2023, 12, 1))]]
    for rows in steps:
        batch = df(spark, rows)
        s.merge(batch)
        t = batch if t is None else up.upsert(t, batch, ["payment_id"])
        assert state(s.read()) == state(t)
        assert s.newest_date() == t.agg(F.max("payment_date")).first()[0]
        again = store(spark, s.root)
        assert again.runs == s.runs and state(again.read()) == state(t)
    assert list(s.runs) == ["2023-12-01"]
    assert sorted(s.read().columns) == ["amount", "m", "payment_date", "payment_id"]


def test_a_failed_merge_publishes_nothing(spark):
    s = store(spark)
    s.merge(df(spark, [("a", 1, D(2024, 1, 1))]))
    with pytest.raises(Exception, match="duplicate key"):
        s.merge(df(spark, [("b", 2, D(2024, 1, 1)), ("b", 3, D(2024, 2, 1))]))
    assert published(spark, s.root)[0] == 1 and state(store(spark, s.root).read()) == [("a", 1, D(2024, 1, 1))]


def test_readers_keep_the_state_they_opened(spark):
    s = store(spark)
    s.merge(df(spark, [("a", 1, D(2024, 1, 1)), ("b", 1, D(2024, 2, 1))]))
    early = store(spark, s.root).read()
    s.merge(df(spark, [("a", 2, D(2024, 2, 1))]))
    assert state(early) == [("a", 1, D(2024, 1, 1)), ("b", 1, D(2024, 2, 1))]
    # untouched months keep their files
    s.merge(df(spark, [("z", 2, D(2024, 5, 1))]))
    assert s.runs == {"2024-02-01": 2, "2024-05-01": 3}


def test_schema_evolution_and_refresh(spark):
    s = store(spark)
    s.merge(df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 2, 2))]))
    s.merge(df(spark, [("b", 5, D(2024, 2, 2), "cash")], SCHEMA + ", method string"))
    assert state(s.read(), ("payment_id", "amount", "method")) == [("a", 1, None), ("b", 5, "cash")]
    s.replace(df(spark, [("x", 1, D(2020, 1, 1))]))
    assert state(store(spark, s.root).read()) == [("x", 1, D(2020, 1, 1))]


def files_touched(folder, column, values):
    """Files whose minimum and maximum do not rule out a value, summed over the values."""
    n = 0
    for d, _, fs in os.walk(folder):
        for f in fs:
            if f.endswith(".parquet"):
                meta = pq.read_metadata(os.path.join(d, f))
                at = meta.schema.names.index(column)
                stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
                low, high = min(x.min for x in stats), max(x.max for x in stats)
                n += sum(low <= v <= high for v in values)
    return n


def test_every_cluster_column_rules_out_files(spark, tmp_path):
    columns = ("bucket_code", "customer_sk", "due_date")
    codes = F.array(*[F.lit(c) for c in ("CURRENT", "B1_29", "B30_59", "B60_89", "B90_PLUS", "DEFAULT")])
    rows = spark.range(40_000).select(F.element_at(codes, (F.col("id") * 7 % 6 + 1).cast("int")).alias("bucket_code"), F.md5((F.col("id") * 31 % 5000).cast("string")).alias("customer_sk"),
                                      F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") * 13 % 900).cast("int")).alias("due_date"), "id")
    borders = rows.agg(*border_aggregates(rows, columns)).first()
    n = 64
    rows.repartitionByRange(n, *columns).sortWithinPartitions(*columns).write.parquet(str(tmp_path / "linear"))
    order = interleaved(rows, columns, borders)
    rows.withColumn("_z", order).repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z").write.parquet(str(tmp_path / "interleaved"))
    sks = [r.k for r in rows.select(F.col("customer_sk").alias("k")).distinct().orderBy(F.xxhash64("k")).limit(20).collect()]
    days = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 900, 45)]
    wanted = {"customer_sk": sks, "due_date": days, "bucket_code": ["DEFAULT"] * 20}
    touched = {kind: {c: files_touched(tmp_path / kind, c, values) / 20 for c, values in wanted.items()} for kind in ("linear", "interleaved")}
    # the sorted form reads nearly every file for a due date; here every predicate rules out most
    assert touched["linear"]["due_date"] > 0.9 * n
    assert max(touched["interleaved"].values()) < n / 2, touched
    assert sum(touched["interleaved"].values()) < sum(touched["linear"].values()), touched


def test_odd_values_have_an_order(spark):
    rows = spark.createDataFrame([(None, None, None), ("", D(1, 1, 1), -1.5), ("é", D(9999, 1, 1), 2.0), ("a" * 50, None, None)], "s string, d date, x double")
    borders = rows.agg(*border_aggregates(rows, ("s", "d", "x"))).first()
    got = rows.select(interleaved(rows, ("s", "d", "x"), borders).alias("z")).collect()
    assert len(got) == 4 and got[0].z == 0
    empty = rows.limit(0).agg(*border_aggregates(rows, ("s", "d", "x"))).first()
    assert {r.z for r in rows.select(interleaved(rows, ("s", "d", "x"), empty).alias("z")).collect()} == {0}
