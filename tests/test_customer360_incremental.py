"""Payment totals kept by changes: equal to the summary of the whole fact after every load."""

import random

from loanmart.operators import upsert as up
from loanmart.plans import customer360 as c360
from loanmart.plans.customer360_incremental import PaymentTotals, changes, added_up
from loanmart.session import scratch_path

SCHEMA = "payment_id string, customer_id bigint, is_on_time_payment boolean, is_delinquent_payment boolean, days_past_due bigint, severity_order int, extra string"


def row(i, customer, dpd):
    return (f"p{i}", customer, dpd == 0, dpd > 30, dpd, 0 if dpd == 0 else 1 + dpd // 30, None)


def summary(df):
    return sorted(tuple(r) for r in df.where("customer_id is not null").select("customer_id", "total_payments", "on_time_payments", "delinquent_payments", "avg_days_past_due", "max_days_past_due", "worst_bucket_ever").collect())


def test_loads_equal_the_whole_summary(spark):
    rnd = random.Random(2)
    kept, fact = PaymentTotals(spark, scratch_path(spark, "totals"), buckets=2), None
    for step in range(6):
        # later loads replace rows: other customers, smaller delays, so maxima go down
        ids = rnd.sample(range(120), 40)
        batch = spark.createDataFrame([row(i, rnd.choice([1, 1, 1, 2, 3, None, 40 + i % 7]), rnd.choice([0, 0, 5, 40, 400 - 60 * step])) for i in ids], SCHEMA)
        kept.load(batch)
        fact = batch if fact is None else up.upsert(fact, batch, ["payment_id"])
        assert summary(kept.summary()) == summary(c360.payments_summary(fact))


def test_a_customer_that_loses_all_payments(spark):
    kept = PaymentTotals(spark, scratch_path(spark, "totals"), buckets=2)
    kept.load(spark.createDataFrame([row(1, 1, 90), row(2, 2, 0)], SCHEMA))
    changed = kept.load(spark.createDataFrame([row(1, 2, 10)], SCHEMA))
    assert sorted(r.customer_id for r in changed.collect()) == [1, 2]
    assert summary(kept.summary()) == [(2, 2, 1, 0, 5.0, 10, 1)]
    assert kept.load(spark.createDataFrame([], SCHEMA)).count() == 0


def test_an_interrupted_load_is_made_good(spark):
    root = scratch_path(spark, "totals")
    kept = PaymentTotals(spark, root, buckets=2)
    kept.load(spark.createDataFrame([row(1, 1, 90)], SCHEMA))
    kept.facts.merge(spark.createDataFrame([row(2, 1, 100)], SCHEMA))  # and no totals after it
    again = PaymentTotals(spark, root)
    again.load(spark.createDataFrame([row(3, 2, 1)], SCHEMA))
    assert summary(again.summary()) == [(1, 2, 0, 2, 95.0, 100, 4), (2, 1, 0, 0, 1.0, 1, 1)]


def test_only_changes_are_shuffled(spark):
    kept = PaymentTotals(spark, scratch_path(spark, "totals"), buckets=4)
    kept.load(spark.createDataFrame([row(i, i % 50, i % 90) for i in range(2000)], SCHEMA))
    batch = spark.createDataFrame([row(i, 7, 3) for i in range(5)], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        gone = kept.facts.read().join(batch.select("payment_id"), "payment_id", "left_semi")
        plan = gone._jdf.queryExecution().executedPlan().toString()
        stored = [line for line in plan.splitlines() if "FileScan" in line]
        assert stored and all("Bucketed: true" in line for line in stored)
        assert plan.count("Exchange") == 1  # the batch
        assert added_up(changes(gone, -1)).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.customer_id for r in kept.load(batch).collect()} == {0, 1, 2, 3, 4, 7}
