"""Payment deliveries: what changed is found by looking at each row, and a backlog takes few micro-batches."""

import datetime as dt
import re
from decimal import Decimal

from loanmart.session import scratch_path
from loanmart.sources import batches
from loanmart.streaming import payments_stream as ps

D = dt.date


def test_a_backlog_of_many_files_takes_few_micro_batches(spark):
    landing = scratch_path(spark, "landing")
    rows = [(f"p{i}", 1, 1, 1, D(2024, 1, 1), D(2024, 1, 3), Decimal(10), Decimal(10), "cash", D(2024, 2, 1)) for i in range(48)]
    spark.createDataFrame(rows, ps.RAW_PAYMENT_SCHEMA).repartition(48).write.parquet(landing)
    sizes = []
    stream = ps.payment_stream(spark, landing, ps.files_per_batch(spark, landing))
    (stream.writeStream.foreachBatch(lambda batch, epoch: sizes.append(batch.count())).option("checkpointLocation", scratch_path(spark, "progress"))
     .trigger(availableNow=True).start().awaitTermination())
    assert sum(sizes) == 48 and len(sizes) <= ps.MAX_BATCHES


def raw_payments(spark, rows):
    return spark.createDataFrame(rows, "payment_id string, origination_id bigint, customer_id bigint, installment_number int, due_date date, "
                                       "payment_date date, due_amount_ars decimal(18,2), paid_amount_ars decimal(20,2), payment_method string")


def test_a_delivery_joins_repeated_keys_only(spark):
    rows = [(None if i % 11 == 0 else f"p{i % 50}" if i % 4 == 0 else f"p{i}", i % 70, 1, 1 + i % 5, D(2024, 1, 1) + dt.timedelta(days=i % 60),
             None if i % 9 == 0 else D(2024, 1, 1) + dt.timedelta(days=i % 62), Decimal(10), Decimal(i), "cash") for i in range(400)]
    raw = raw_payments(spark, rows)
    repeated = batches.repeated_payments(raw)
    assert repeated.count() > 0
    for since, until in ((None, D(2024, 1, 20)), (D(2024, 1, 20), D(2024, 2, 1)), (D(2024, 2, 1), D(2024, 4, 1))):
        changed = batches.payment_changes_between(spark, raw, since, until)
        want = batches.payment_source(spark, raw, until).join(changed, "payment_id", "left_semi")
        got = batches.payment_delivery(spark, raw, since, until, repeated).select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_a_delivery_of_a_landed_source_reads_the_months_around_it(spark):
    rows = [(f"p{i % 700}" if i % 50 == 0 else f"p{i}", i, 1, i % 9 - 4, D(2024, 1, 1) + dt.timedelta(days=i % 200),
             None if i % 9 == 0 else D(2023, 12, 28) + dt.timedelta(days=i % 210), Decimal(10), Decimal(i), "cash") for i in range(1500)]
    raw = raw_payments(spark, rows)
    landed = batches.land_payments(raw, scratch_path(spark, "landed"))
    repeated = batches.repeated_payments(raw).cache()
    assert repeated.count() > 0
    for since, until in ((None, D(2024, 1, 20)), (D(2024, 3, 3), D(2024, 4, 1)), (D(2024, 4, 4), D(2024, 5, 29)), (D(2024, 5, 1), D(2024, 12, 1))):
        want = batches.payment_delivery(spark, raw, since, until, repeated)
        got = batches.payment_delivery(spark, landed, since, until, repeated).select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
        assert re.search(r"PartitionFilters: \[[^,]*payment_month", got._jdf.queryExecution().executedPlan().toString())
