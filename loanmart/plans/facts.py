"""Fact tables: applications, originations, payments (full and incremental)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.functions.columns import days_between, ratio, surrogate_key
from loanmart.operators import upsert as up
from loanmart.operators.keyed_store import KeyedStore
from loanmart.operators.partition_store import PartitionStore
from loanmart.params import DEFAULT, RunParams

LOOKBACK_DAYS = 3
PAYMENT_KEY = "payment_id"
PAYMENT_PARTITION = "payment_month"
PAYMENT_CLUSTER = ("bucket_code", "customer_sk", "due_date")

FCT_APPLICATION_COLUMNS = [
    "application_id", "customer_id", "product_code", "origination_id", "channel",
    "application_status", "is_approved", "is_rejected", "is_pending", "was_originated",
    "approved_not_taken", "requested_amount_ars", "approved_amount_ars", "approval_ratio",
    "days_to_decision", "days_decision_to_origination", "application_date", "decision_date",
    "origination_date",
]

FCT_PAYMENT_COLUMNS = [
    "customer_sk", "payment_id", "origination_id", "customer_id", "installment_number",
    "payment_method", "bucket_code", "bucket_name", "is_delinquent_payment", "is_on_time_payment",
    "severity_order", "days_past_due", "due_amount_ars", "paid_amount_ars", "payment_variance_ars",
    "due_date", "payment_date",
]


def _stamp(p: RunParams):
    return F.lit(p.run_ts).cast("timestamp").alias("dbt_updated_at")


def fct_applications(applications_outcome: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return applications_outcome.select(*FCT_APPLICATION_COLUMNS, _stamp(p))


def fct_originations(stg_originations: DataFrame, stg_applications: DataFrame,
                     p: RunParams = DEFAULT) -> DataFrame:
    """Origination with its application context (left join on application_id)."""
    o = stg_originations.alias("o")
    a = stg_applications.select("application_id", "channel", "requested_amount_ars",
                                "application_date", "decision_date", "days_to_decision").alias("a")
    return o.join(a, F.col("o.application_id") == F.col("a.application_id"), "left").select(
        "o.origination_id", "o.customer_id", "o.product_code",
        F.col("o.application_id").alias("application_id"),
        F.col("a.channel").alias("origination_channel"),
        "o.term_months", "o.approved_amount_ars", "a.requested_amount_ars",
        ratio(F.col("o.approved_amount_ars"), F.col("a.requested_amount_ars"), 4).alias("approval_ratio"),
        "o.annual_interest_rate_pct", "o.monthly_interest_rate_pct",
        "o.estimated_monthly_installment_ars",
        "a.application_date", "a.decision_date", "o.origination_date", "o.first_payment_due_date",
        "o.origination_cohort", "a.days_to_decision",
        days_between(F.col("o.origination_date"), F.col("a.decision_date")).alias("days_decision_to_origination"),
        _stamp(p),
    )


def fct_payments(payments_bucketed: DataFrame, p: RunParams = DEFAULT,
                 columns: Sequence[str] = FCT_PAYMENT_COLUMNS) -> DataFrame:
    """Payment fact rows (full refresh form): surrogate customer key + projection."""
    withkey = payments_bucketed.withColumn("customer_sk", surrogate_key("customer_id"))
    return withkey.select(*columns, _stamp(p))


# --- incremental load -------------------------------------------------------

def payments_increment(payments_bucketed: DataFrame, target: DataFrame | None,
                       p: RunParams = DEFAULT, lookback_days: int = LOOKBACK_DAYS,
                       columns: Sequence[str] = FCT_PAYMENT_COLUMNS) -> DataFrame:
    """The rows one incremental run loads: everything on the first run, else
    payments dated within ``lookback_days`` of the newest payment in the target."""
    slice_ = up.lookback_slice(payments_bucketed, target, "payment_date", lookback_days)
    return fct_payments(slice_, p, columns)


def incremental_runs(sources: Sequence[tuple[DataFrame, RunParams]], cut: Callable | None,
                     lookback_days: int = LOOKBACK_DAYS,
                     columns_per_run: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Run the incremental payment fact over successive states of its source.

    ``sources[k]`` is the bucketed payment view as seen by run k. Each run
    loads its lookback slice and merges it by ``payment_id``. ``cut``
    materialises the table after each run (as the scheduled job writes it),
    keeping each run's plan to one merge.
    """
    target = None
    for k, (bucketed, p) in enumerate(sources):
        cols = columns_per_run[k] if columns_per_run else FCT_PAYMENT_COLUMNS
        batch = up.guard_unique(payments_increment(bucketed, target, p, lookback_days, cols),
                                [PAYMENT_KEY])
        rows = None
        if cut is not None:
            batch = cut(batch)
            if target is not None:
                rows = batch.count()  # written batch: a cheap count, decides the broadcast
        target = batch if target is None else up.upsert(target, batch, [PAYMENT_KEY], check_unique=False,
                                                         batch_rows=rows,
                                                         max_broadcast_rows=p.max_broadcast_rows)
        if cut is not None and k < len(sources) - 1:
            target = cut(target)
    return target


def payments_since(feed: Callable[[dt.date | None], DataFrame], newest: dt.date | None, first_run: bool,
                   p: RunParams = DEFAULT, lookback_days: int = LOOKBACK_DAYS,
                   columns: Sequence[str] = FCT_PAYMENT_COLUMNS) -> DataFrame:
    """The rows one incremental run loads, read from a feed that skips what is older.

    ``newest``: newest payment date of the target; None for an empty one, which loads nothing.
    """
    if first_run:
        return fct_payments(feed(None), p, columns)
    since = None if newest is None else newest - dt.timedelta(days=lookback_days)
    return fct_payments(up.lookback_slice_from(feed(since), newest, "payment_date", lookback_days), p, columns)


def incremental_runs_stored(spark: SparkSession, root: str, feeds: Sequence[tuple[Callable, RunParams]],
                            lookback_days: int = LOOKBACK_DAYS,
                            columns_per_run: Sequence[Sequence[str]] | None = None, buckets: int = 8) -> DataFrame:
    """The runs on a table bucketed by ``payment_id``: each writes its lookback slice and nothing
    else (:class:`loanmart.operators.keyed_store.KeyedStore`)."""
    store = KeyedStore(spark, root, [PAYMENT_KEY], buckets)
    for k, (feed, p) in enumerate(feeds):
        cols = columns_per_run[k] if columns_per_run else FCT_PAYMENT_COLUMNS
        first = not store.exists()
        newest = None if first else store.max_value("payment_date")
        store.merge(payments_since(feed, newest, first, p, lookback_days, cols))
    return store.read()


def incremental_runs_by_month(spark: SparkSession, root: str, feeds: Sequence[tuple[Callable, RunParams]],
                              lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The runs on a table partitioned by payment month and clustered by (bucket_code, customer_sk,
    due_date); each rewrites the months it touches, once, and publishes them together."""
    store = None
    for feed, p in feeds:
        store = PartitionStore(spark, root, [PAYMENT_KEY], "payment_date", PAYMENT_PARTITION, PAYMENT_CLUSTER, p.max_broadcast_rows)
        first = not store.exists()
        store.merge(payments_since(feed, None if first else store.newest_date(), first, p, lookback_days))
    return store.read()


def incremental_step(spark: SparkSession, target_path: str, bucketed: DataFrame, p: RunParams,
                     first_run: bool, lookback_days: int = LOOKBACK_DAYS) -> None:
    """One run of the payment fact on its month-partitioned table: everything on the
    first run (or a full refresh), else the lookback slice merged by ``payment_id``."""
    target = None if first_run else spark.read.option("mergeSchema", "true").parquet(target_path)
    batch = payments_increment(bucketed, target, p, lookback_days)
    up.merge_into_partitions(spark, target_path, batch, [PAYMENT_KEY], "payment_date",
                             PAYMENT_PARTITION, PAYMENT_CLUSTER, first_run=first_run,
                             max_broadcast_rows=p.max_broadcast_rows)


def incremental_runs_partitioned(spark: SparkSession, target_path: str,
                                 sources: Sequence[tuple[DataFrame, RunParams]],
                                 lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Same runs, persisted as a month-partitioned Parquet table clustered by
    (bucket_code, customer_sk, due_date); each run rewrites only touched months."""
    for k, (bucketed, p) in enumerate(sources):
        incremental_step(spark, target_path, bucketed, p, k == 0, lookback_days)
    return spark.read.option("mergeSchema", "true").parquet(target_path)
