"""Deliveries by event time: repeats dropped, out-of-order rows taken, too-late rows set aside."""

import datetime as dt
from decimal import Decimal

from loanmart.sources import seeds
from loanmart.streaming import event_time as et
from loanmart.streaming.payments_stream import RAW_PAYMENT_SCHEMA
from loanmart.session import scratch_path

D = dt.date


def row(i, day, paid):
    return (i, 1, 1, 1, D(2024, 1, 1), D(2024, 1, 3), Decimal(10), Decimal(paid), "cash", D(2024, 2, day))


def test_out_of_order_repeated_and_late_rows(spark):
    landing, target, taken, progress = (scratch_path(spark, f"et_{x}") for x in ("landing", "target", "taken", "progress"))
    buckets = seeds.delinquency_buckets(spark)
    steps = [[row("a", 5, 1), row("b", 5, 1)], [row("a", 9, 3)], [row("a", 9, 3), row("a", 9, 3)],  # repeats
             [row("b", 7, 2), row("c", 7, 2)],  # late, within the delay
             [row("d", 20, 5)], [row("e", 6, 6), row("e", 6, 6), row("b", 10, 9)]]  # too late
    for rows in steps:
        spark.createDataFrame(rows, RAW_PAYMENT_SCHEMA).write.mode("append").parquet(landing)
        et.run_load(spark, landing, target, taken, progress, "4 days", buckets)
    got = {r.payment_id: (int(r.paid_amount_ars), r.delivered_at.day) for r in spark.read.parquet(target).collect()}
    assert got == {"a": (3, 9), "b": (2, 7), "c": (2, 7), "d": (5, 20)}
    late = et.late_rows(spark, landing, taken)
    assert sorted((r.payment_id, r.delivered_at.day, int(r.paid_amount_ars)) for r in late.collect()) == [("b", 10, 9), ("e", 6, 6)]
    assert set(late.columns) == set(RAW_PAYMENT_SCHEMA.fieldNames())
    # a run without new files changes nothing
    et.run_load(spark, landing, target, taken, progress, "4 days", buckets)
    assert spark.read.parquet(target).count() == 4


def test_the_state_forgets_what_the_watermark_has_passed(spark):
    landing, target, taken, progress = (scratch_path(spark, f"et_{x}") for x in ("landing", "target", "taken", "progress"))
    buckets = seeds.delinquency_buckets(spark)
    sizes = []
    for day in range(1, 25, 4):
        spark.createDataFrame([row(f"p{day}-{i}", day, 1) for i in range(50)], RAW_PAYMENT_SCHEMA).write.mode("append").parquet(landing)
        q = et.run_load(spark, landing, target, taken, progress, "5 days", buckets)
        sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    # the state holds the deliveries of one delay: it stops growing
    assert spark.read.parquet(target).count() == 300
    assert sizes[0] < sizes[1] and sizes[2:] == [sizes[2]] * 4 and sizes[2] <= 3 * sizes[0]


def test_a_micro_batch_goes_through_the_state_once_and_merges_only_rows(spark, monkeypatch):
    landing, target, taken, progress = (scratch_path(spark, f"et_{x}") for x in ("landing", "target", "taken", "progress"))
    buckets, merges, merge = seeds.delinquency_buckets(spark), [], et.up.merge_into_partitions

    def noted(spark, path, rows, *args, **kwargs):
        merges.append(("DeduplicateWithinWatermark" in rows._jdf.queryExecution().analyzed().toString(), rows.count()))
        merge(spark, path, rows, *args, **kwargs)

    monkeypatch.setattr(et.up, "merge_into_partitions", noted)
    for rows in ([row("a", 1, 1), row("b", 1, 1), row("b", 1, 1)], [row("c", 20, 1)], [row("d", 2, 1)], [row("a", 21, 2), row("c", 20, 1)]):
        spark.createDataFrame(rows, RAW_PAYMENT_SCHEMA).write.mode("append").parquet(landing)
        et.run_load(spark, landing, target, taken, progress, "4 days", buckets)
    # batches that move the watermark only, or hold late rows only, are noted and not merged
    assert merges == [(False, 2), (False, 1), (False, 1)]
    assert sorted((r.payment_id, int(r.paid_amount_ars)) for r in spark.read.parquet(target).collect()) == [("a", 2), ("b", 1), ("c", 1)]
    assert [r.payment_id for r in et.late_rows(spark, landing, taken).collect()] == ["d"]
