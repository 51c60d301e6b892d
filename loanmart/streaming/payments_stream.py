"""Incremental payment fact driven by Structured Streaming.

Raw payment rows arrive as files in a landing folder (each row carries the
time it was delivered). A file-source stream picks them up; each micro-batch
runs the staging and bucketing models, keeps the latest delivered version of
every payment (``max_by``, partial aggregation) and merges it into the
month-partitioned payment fact with
:func:`loanmart.operators.upsert.merge_into_partitions`. The table keeps each
row's delivery time, and a row only replaces one that was not delivered later:
files may arrive in any order.

Late rows need no lookback window here: a row is processed when it is
delivered, whatever its payment date. ``foreachBatch`` may replay a
micro-batch after a failure; the merge is keyed, so a replay leaves the
table unchanged (effectively exactly-once). The stream's progress lives in
``checkpoint_location``, which must be in shared storage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from loanmart.operators import upsert as up
from loanmart.params import DEFAULT, RunParams
from loanmart.plans import facts, intermediate, staging
from loanmart.session import materialize
from loanmart.sources import batches

# Column of the target that orders the versions of a payment.
VERSION = "delivered_at"

RAW_PAYMENT_SCHEMA = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("origination_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("installment_number", T.IntegerType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("due_amount_ars", T.DecimalType(18, 2)),
    T.StructField("paid_amount_ars", T.DecimalType(20, 2)),
    T.StructField("payment_method", T.StringType()),
    T.StructField("delivered_at", T.DateType()),
])


# Micro-batches that a backlog is taken in at most. Every one merges into the fact, so
# their number must not grow with the files that landed.
MAX_BATCHES = 8


def write_deliveries(spark: SparkSession, raw_payments: DataFrame, run_dates: Sequence[dt.date],
                     landing_dir: str) -> None:
    """Stand-in for the upstream system: one delivery per run window.

    Delivery k holds, as of ``run_dates[k]``, every payment that appeared or
    was corrected in ``[run_dates[k-1], run_dates[k])`` (see
    :mod:`loanmart.sources.batches` for the arrival rules).
    """
    repeated = materialize(batches.repeated_payments(raw_payments), "repeated_payments")
    for k in range(len(run_dates)):
        write_delivery(spark, raw_payments, run_dates, k, landing_dir, repeated)


def write_delivery(spark: SparkSession, raw_payments: DataFrame, run_dates: Sequence[dt.date], k: int, landing_dir: str,
                   repeated: DataFrame | None = None) -> None:
    """Land delivery ``k`` (from 0). ``repeated``: the keys that several rows share, if the
    caller has them already (:func:`loanmart.sources.batches.repeated_payments`)."""
    d, prev = run_dates[k], run_dates[k - 1] if k else None
    delivery = (batches.payment_delivery(spark, raw_payments, prev, d, batches.repeated_payments(raw_payments) if repeated is None else repeated)
                .withColumn("delivered_at", F.lit(d - dt.timedelta(days=1))))
    (delivery.select(*[f.name for f in RAW_PAYMENT_SCHEMA.fields])
     .write.mode("append").parquet(landing_dir))


def payment_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 4) -> DataFrame:
    return (spark.readStream.schema(RAW_PAYMENT_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(landing_dir))


def files_per_batch(spark: SparkSession, landing_dir: str, max_batches: int = MAX_BATCHES, at_least: int = 4) -> int:
    """Files of a micro-batch so that what lies in the landing folder takes at most ``max_batches``."""
    landed = spark.read.schema(RAW_PAYMENT_SCHEMA).parquet(landing_dir).inputFiles()
    return max(at_least, ceil(len(landed) / max_batches))


def latest_delivered(batch: DataFrame, key: str = "payment_id") -> DataFrame:
    """Latest delivered version of each key in a micro-batch."""
    cols = [c for c in batch.columns if c != key]
    return (batch.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col("delivered_at")).alias("v"))
            .select(key, *[F.col(f"v.{c}").alias(c) for c in cols]))


def start_payment_load(spark: SparkSession, stream: DataFrame, target_path: str,
                       checkpoint_location: str, buckets: DataFrame,
                       p: RunParams = DEFAULT, available_now: bool = True) -> StreamingQuery:
    """Start the streaming load; returns the running query."""

    def process(batch_df: DataFrame, epoch_id: int) -> None:
        # Classify first, then keep the latest classified version of each key:
        # the same result as merging the deliveries one by one, however the
        # stream groups them into micro-batches (a version without a bucket
        # replaces nothing).
        carry = ("delivered_at",)
        bucketed = intermediate.payments_bucketed(staging.stg_payments(batch_df, p, carry), buckets, p,
                                                  carry=carry)
        latest = latest_delivered(bucketed.drop("dbt_loaded_at"))
        fct = facts.fct_payments(latest, p, [*facts.FCT_PAYMENT_COLUMNS, VERSION])
        exists = _table_exists(spark, target_path)
        up.merge_into_partitions(spark, target_path, fct, [facts.PAYMENT_KEY], "payment_date",
                                 facts.PAYMENT_PARTITION, facts.PAYMENT_CLUSTER,
                                 first_run=not exists, max_broadcast_rows=p.max_broadcast_rows,
                                 version_col=VERSION)

    w = (stream.writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint_location)
         .queryName(f"payment_load_{abs(hash(target_path)) % 10**8}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # resolving the path fails if nothing was written yet
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
