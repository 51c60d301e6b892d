"""The model graph for one set of raw tables, built lazily.

Calling a model is a plain function call on its inputs; this class only
memoises the DataFrames so a model used by several consumers is one plan
node (Spark can then reuse its exchanges).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators import scd2
from loanmart.params import DEFAULT, RunParams
from loanmart.plans import customer360 as c360
from loanmart.plans import dims, facts, intermediate, staging
from loanmart.session import materialize, scratch_path
from loanmart.sources import batches, seeds
from loanmart.sources.raw_fixtures import RawTables

SNAPSHOT_COLUMNS = ["customer_id", "bureau_score", "total_debt_ars", "active_debts_count",
                    "delinquencies_last_12m", "has_default_history", "report_date"]


def snapshot_input(raw_bureau: DataFrame) -> DataFrame:
    """Snapshot projection: tracked columns as delivered, report date as a timestamp."""
    return raw_bureau.select(*SNAPSHOT_COLUMNS[:-1],
                             F.col("report_date").cast("timestamp").alias("report_date"))


class Models:
    """``seed_dir``: folder of the seed CSVs; without it the built-in lists and the
    holiday rule are used. ``holidays``: a holiday table that takes the rule's place."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT,
                 seed_dir: str | None = None, holidays: DataFrame | None = None):
        self.seed_dir = seed_dir
        self.holidays = seeds.read_seed(spark, seed_dir, "holidays") if seed_dir and holidays is None else holidays
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params
        self.raw = RawTables(spark, sf_dir)
        self._written: set[str] = set()
        self.observed: dict[str, dict[str, int]] = {}  # failures gathered while a table was written

    def write_tables(self, names: list[str], write: Callable[[str, DataFrame], DataFrame] = lambda name, df: materialize(df, name)) -> None:
        """Write the named tables once and use the written copies from then on.

        For queries that read the same tables many times (the quality suite):
        each table is computed once instead of once per consumer. Names are
        raw tables (``raw_*``, driver table names) or model attributes, given
        in dependency order so later models build on earlier written ones.
        """
        for n in names:
            if n in self._written:
                continue
            if n in self.raw._cache or n.startswith("raw_") and n != "raw_credit_bureau" \
                    or n in ("lineitem", "customer", "orders", "events"):
                self.raw._cache[n] = write(n, self.raw.get(n))
            else:
                self.__dict__[n] = write(n, getattr(self, n))
            self._written.add(n)

    # --- raw bureau as a sequence of daily feed states ----------------------
    @cached_property
    def bureau_days(self) -> list[dt.date]:
        return batches.bureau_days(self.raw.bureau_feed)

    def bureau_batches(self) -> list[tuple[DataFrame, dt.datetime]]:
        return [(batches.bureau_batch(self.spark, self.raw.bureau_feed, d, batches.BUREAU_AWAY.get(k)),
                 batches.bureau_run_ts(d)) for k, d in enumerate(self.bureau_days, start=1)]

    @cached_property
    def raw_credit_bureau(self) -> DataFrame:
        """The bureau table as of the last run."""
        return self.bureau_batches()[-1][0]

    # --- staging ------------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers, self.p)

    @cached_property
    def stg_applications(self) -> DataFrame:
        return staging.stg_applications(self.raw.applications, self.p)

    @cached_property
    def stg_originations(self) -> DataFrame:
        return staging.stg_originations(self.raw.originations, self.p)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw.payments, self.p)

    @cached_property
    def stg_credit_bureau(self) -> DataFrame:
        return staging.stg_credit_bureau(self.raw_credit_bureau, self.p)

    # --- history ------------------------------------------------------------
    @cached_property
    def bureau_snapshot(self) -> str:
        """Folder of the stored history after every feed day has been snapshotted."""
        root = scratch_path(self.spark, "bureau_snapshot")
        for batch, ts in self.bureau_batches():
            scd2.run_snapshot(root, snapshot_input(batch), "customer_id", "report_date", ts)
        return root

    @cached_property
    def bureau_history(self) -> DataFrame:
        """Type-2 history of the bureau reports."""
        return scd2.stored_history(self.spark, self.bureau_snapshot)

    @cached_property
    def bureau_open(self) -> DataFrame:
        """Current versions of the bureau reports."""
        return scd2.stored_open(self.spark, self.bureau_snapshot)

    # --- seeds ----------------------------------------------------------------
    @cached_property
    def buckets(self) -> DataFrame:
        return seeds.read_seed(self.spark, self.seed_dir, "buckets") if self.seed_dir else seeds.delinquency_buckets(self.spark)

    @property
    def bucket_rows(self) -> int | None:
        """Rows of the bands where they are the built-in list; a file's rows are counted."""
        return None if self.seed_dir else seeds.SEED_ROWS["buckets"]

    @cached_property
    def product_catalog(self) -> DataFrame:
        return seeds.read_seed(self.spark, self.seed_dir, "products") if self.seed_dir else seeds.products(self.spark)

    # --- intermediate ---------------------------------------------------------
    @cached_property
    def customers_enriched(self) -> DataFrame:
        return intermediate.customers_enriched(self.stg_customers, self.bureau_open, self.p)

    @cached_property
    def applications_outcome(self) -> DataFrame:
        return intermediate.applications_outcome(self.stg_applications, self.stg_originations, self.p)

    @cached_property
    def payments_bucketed(self) -> DataFrame:
        return intermediate.payments_bucketed(self.stg_payments, self.buckets, self.p, self.bucket_rows)

    # --- dims -------------------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.customers_enriched, self.p)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.product_catalog, self.p)

    @cached_property
    def calendar_bounds(self) -> DataFrame:
        """Whole years around every application, origination, due and payment date."""
        a, o, pay = self.raw.applications, self.raw.originations, self.raw.payments
        return dims.data_calendar_bounds(
            [[F.col("application_date")], [F.col("origination_date")],
             [F.col("due_date"), F.col("payment_date")]],
            [a, o, pay])

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.calendar_bounds, self.holidays, self.p)

    # --- facts ------------------------------------------------------------------
    @cached_property
    def fct_applications(self) -> DataFrame:
        return facts.fct_applications(self.applications_outcome, self.p)

    @cached_property
    def fct_originations(self) -> DataFrame:
        return facts.fct_originations(self.stg_originations, self.stg_applications, self.p)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return facts.fct_payments(self.payments_bucketed, self.p)

    @cached_property
    def payment_source_table(self) -> DataFrame:
        """The raw payment table landed once by month of payment, so successive runs scan
        the months they need instead of rebuilding it from the driver tables."""
        return batches.land_payments(self.raw.payments, scratch_path(self.spark, "raw_payments"))

    def bucketed_as_of(self, run_date: dt.date, since: dt.date | None = None) -> DataFrame:
        """The bucketed payment view over the payment source as seen on ``run_date``; with
        ``since`` at least its payments dated on or after that day."""
        src = batches.payment_source(self.spark, self.payment_source_table, run_date, since)
        return intermediate.payments_bucketed(staging.stg_payments(src, self.p), self.buckets, self.p, self.bucket_rows)

    @cached_property
    def payment_run_dates(self) -> list[dt.date]:
        return batches.payment_run_dates(self.spark, self.payment_source_table)

    def payment_feeds(self, runs: Sequence[int] | None = None) -> list[tuple[Callable[[dt.date | None], DataFrame], RunParams]]:
        """(feed, run parameters) of the numbered runs (from 1; default all); ``feed(since)`` gives the
        bucketed payments as of the run, at least those dated on or after ``since`` (None: all)."""
        out = []
        for k in runs or range(1, len(self.payment_run_dates) + 1):
            d = self.payment_run_dates[k - 1]
            p = RunParams(as_of=d, run_ts=dt.datetime.combine(d, dt.time(6)), mask_pii=self.p.mask_pii,
                          max_broadcast_rows=self.p.max_broadcast_rows)
            out.append((partial(self.bucketed_as_of, d), p))
        return out

    def payment_runs(self, runs: Sequence[int] | None = None) -> list[tuple[DataFrame, RunParams]]:
        """(bucketed payments as of the run, run parameters) of the numbered runs (from 1; default all)."""
        return [(feed(None), p) for feed, p in self.payment_feeds(runs)]

    # --- aggregate ----------------------------------------------------------------
    @cached_property
    def customer_360(self) -> DataFrame:
        return c360.customer_360(self.dim_customers, self.fct_applications, self.fct_originations,
                                 self.fct_payments, self.p)
