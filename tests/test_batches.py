"""Run dates follow the data: the last run sees everything, whatever the dates."""

import datetime as dt

from pyspark.sql import functions as F

from loanmart.sources import batches


def test_feed_days_cover_any_span(spark):
    rows = [(k, k % 5, 600 + k, 1, 0, False, 1.0, dt.datetime(2019, 3, 1) + dt.timedelta(days=97 * k)) for k in range(40)]
    feed = spark.createDataFrame(rows, "event_id long, customer_id long, bureau_score int, active_debts_count int, delinquencies_last_12m int, has_default_history boolean, total_debt_ars double, report_ts timestamp")
    days = batches.bureau_days(feed)
    assert len(days) == batches.BUREAU_RUNS and days == sorted(days) and days[-1] == max(r[-1] for r in rows).date()
    last = batches.bureau_batch(spark, feed, days[-1], None)
    assert {r.customer_id: r.bureau_score for r in last.collect()} == {c: max(r[2] for r in rows if r[1] == c) for c in range(5)}
    assert batches.bureau_days(feed.limit(0)) == [dt.date(1970, 1, 1)] * batches.BUREAU_RUNS


def test_payment_runs_cover_late_arrivals(spark):
    rows = [(f"p{k}", k, 1, k, dt.date(2015, 1, 1) + dt.timedelta(days=300 * k), dt.date(2015, 1, 1) + dt.timedelta(days=300 * k), k) for k in range(20)]
    raw = spark.createDataFrame(rows, "payment_id string, origination_id long, customer_id long, installment_number int, due_date date, payment_date date, n int").select(
        "*", F.lit(10).cast("decimal(18,2)").alias("due_amount_ars"), F.lit(10).cast("decimal(20,2)").alias("paid_amount_ars"), F.lit("card").alias("payment_method"))
    runs = batches.payment_run_dates(spark, raw)
    assert len(runs) == batches.PAYMENT_RUNS and runs == sorted(runs)
    assert batches.payment_source(spark, raw, runs[-1]).count() == len(rows)
    changed = sum(batches.payment_changes_between(spark, raw, a, b).count() for a, b in zip([None, *runs], runs))
    assert changed >= len(rows)
