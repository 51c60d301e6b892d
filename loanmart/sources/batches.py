"""Stand-in inputs for the stateful loads (history snapshot and incremental merge).

The raw tables only describe one moment. The snapshot and the incremental
load need the raw tables *as they were at successive run times*; these
statements give exactly that, in the raw schemas, and nothing more:

* bureau: the feed table as of day D keeps the latest report per customer
  (reports dated on or before D); one slice of customers is missing from a
  middle run and comes back at the next one (some with a newer report, some
  without), another is missing from the last run, i.e. deleted at the source;
* payments: each payment row becomes visible some days after its payment date
  (0-3 days late) and a few rows are corrected after they first appear
  (paid amount changed; payment date moved into the previous month).

The SQL text is shared with the DuckDB oracle, like ``raw_fixtures``.

The payment source is landed as a table partitioned by month of payment
(:func:`land_payments`), so a run that only wants recent payments reads recent
months.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Snapshot runs and incremental payment runs; their dates divide the data's own span
# evenly and the last one covers everything.
BUREAU_RUNS = 6
PAYMENT_RUNS = 8
# Customers missing from a run's feed: run -> remainder of customer_id modulo
# BUREAU_AWAY_MOD. The first slice comes back at the next run, the last stays away.
BUREAU_AWAY_MOD = 20
BUREAU_AWAY = {4: 1, BUREAU_RUNS: 0}


def _divide(lo: dt.date | None, hi: dt.date | None, runs: int) -> list[dt.date]:
    if lo is None or hi is None:  # no dated rows: the runs see nothing
        lo = hi = dt.date(1970, 1, 1)
    return [lo + dt.timedelta(days=(hi - lo).days * k // runs) for k in range(1, runs + 1)]


def bureau_days(feed: DataFrame) -> list[dt.date]:
    """Feed day of each snapshot run, from the first and last report (two scalars)."""
    lo, hi = feed.agg(F.min(F.to_date("report_ts")), F.max(F.to_date("report_ts"))).first()
    return _divide(lo, hi, BUREAU_RUNS)


def bureau_run_ts(day: dt.date) -> dt.datetime:
    """Snapshot run time for a feed day: the following midnight."""
    return dt.datetime.combine(day + dt.timedelta(days=1), dt.time())


def bureau_batch(spark: SparkSession, feed: DataFrame, day: dt.date, away: int | None) -> DataFrame:
    """raw_credit_bureau as of ``day``: latest report per customer, without the slice
    of customers that is ``away``.

    Uses ``max_by`` (partial aggregation) rather than a per-key window, so a
    customer with a very large number of reports does not land in one task.
    """
    latest = (feed.where(F.to_date("report_ts") <= F.lit(day))
              .groupBy("customer_id")
              .agg(F.max_by(F.struct("bureau_score", "total_debt_ars", "active_debts_count",
                                     "delinquencies_last_12m", "has_default_history", "report_ts"),
                            F.struct("report_ts", "event_id")).alias("r")))
    out = latest.select(
        "customer_id", "r.bureau_score", "r.active_debts_count", "r.delinquencies_last_12m",
        "r.total_debt_ars", "r.has_default_history",
        F.to_date("r.report_ts").alias("report_date"))
    if away is not None:
        out = out.where(F.col("customer_id") % BUREAU_AWAY_MOD != away)
    return out


# The same bounds and batches for the DuckDB oracle (CTE ``bureau_feed``).
BUREAU_BOUNDS_SQL = """
select coalesce(min(cast(report_ts as date)), date '1970-01-01') as lo,
  coalesce(max(cast(report_ts as date)), date '1970-01-01') as hi
from bureau_feed"""


def bureau_day_sql(run: int) -> str:
    return f"(select lo + cast((hi - lo) * {run} // {BUREAU_RUNS} as integer) from bureau_bounds)"


def bureau_batch_sql(run: int) -> str:
    cond = f" and customer_id % {BUREAU_AWAY_MOD} <> {BUREAU_AWAY[run]}" if run in BUREAU_AWAY else ""
    return f"""
select customer_id, bureau_score, active_debts_count, delinquencies_last_12m, total_debt_ars,
  has_default_history, cast(report_ts as date) as report_date
from (select *, row_number() over (partition by customer_id order by report_ts desc, event_id desc) as rn
      from bureau_feed where cast(report_ts as date) <= {bureau_day_sql(run)}) x
where rn = 1{cond}"""


# Moments at which applications are looked at again, for joins with the history: the
# applications' own span of days is laid over the bureau feed's, two days longer, so that
# some lie before a customer's first report and some after the last run.
def application_reviews(applications: DataFrame, feed: DataFrame) -> DataFrame:
    """application_id, customer_id and ``review_ts`` of every application (four scalars are read)."""
    first, last = applications.agg(F.min("application_date"), F.max("application_date")).first()
    lo, hi = feed.agg(F.min(F.to_date("report_ts")), F.max(F.to_date("report_ts"))).first()
    rows = applications.select("application_id", "customer_id", "application_date")
    if first is None or lo is None:
        return rows.select("application_id", "customer_id", F.col("application_date").cast("timestamp").alias("review_ts"))
    days, span = (hi - lo).days + 3, (last - first).days + 1
    at = F.floor(F.datediff("application_date", F.lit(first)) * F.lit(days) / F.lit(span)).cast("int")
    seconds = F.unix_timestamp(F.date_add(F.lit(lo), at).cast("timestamp")) + F.col("application_id") % 24 * 3600
    return rows.select("application_id", "customer_id", F.timestamp_seconds(seconds).alias("review_ts"))


APPLICATION_REVIEWS_SQL = """
select application_id, customer_id,
  cast(b.lo + cast((application_date - a.lo) * (b.hi - b.lo + 3) // (a.hi - a.lo + 1) as integer) as timestamp)
    + to_hours(cast(application_id % 24 as integer)) as review_ts
from raw_applications, bureau_bounds b,
  (select min(application_date) as lo, max(application_date) as hi from raw_applications) a"""


# Most days between a payment and its arrival, either way (installment_number % 4).
ARRIVAL_DAYS = 3

# Payment source as of a run date. arrival = payment day (or due day if
# unpaid) + (installment_number % 4) days. Corrections arrive one day after
# the row itself: amount +1.00 on one slice of rows; on another slice, a
# payment made on the 1st of a month is re-dated to the previous day.
PAYMENT_ARRIVALS = """
select *,
  coalesce(payment_date, due_date) + cast(installment_number % 4 as int) as arrival,
  (origination_id % 7 = 3 and installment_number % 4 = 2) as amount_fix,
  (origination_id % 5 = 1 and installment_number % 4 = 0 and payment_date is not null
   and extract(day from payment_date) = 1) as date_fix
from {raw_payments}"""

PAYMENT_SOURCE = """
select payment_id, origination_id, customer_id, installment_number, due_date,
  case when date_fix and arrival + 1 < {run_date} then payment_date - 1 else payment_date end as payment_date,
  due_amount_ars,
  case when amount_fix and arrival + 1 < {run_date}
       then paid_amount_ars + cast(1.00 as decimal(4,2)) else paid_amount_ars end as paid_amount_ars,
  payment_method
from (""" + PAYMENT_ARRIVALS + """) s
where arrival < {run_date}
"""

# Keys that appear or are corrected in [from_date, run_date).
PAYMENT_CHANGES = """
select payment_id
from (""" + PAYMENT_ARRIVALS + """) s
where (arrival >= {from_date} and arrival < {run_date})
   or ((amount_fix or date_fix) and arrival + 1 >= {from_date} and arrival + 1 < {run_date})
"""


# Rows of PAYMENT_SOURCE that themselves are among these changes, and the others with a key.
PAYMENT_CHANGED = PAYMENT_SOURCE.rstrip() + """
  and {which} coalesce((arrival >= {from_date} and arrival < {run_date})
   or ((amount_fix or date_fix) and arrival + 1 >= {from_date} and arrival + 1 < {run_date}), false)
  and payment_id is not null
"""


# First arrival, and the day after the last correction has arrived.
PAYMENT_BOUNDS = """
select min(arrival) as lo, max(arrival) + 2 as hi
from (""" + PAYMENT_ARRIVALS + """) s
"""


def _date(d: dt.date) -> str:
    return f"date '{d.isoformat()}'"


def payment_run_dates(spark: SparkSession, raw_payments: DataFrame) -> list[dt.date]:
    """Run dates of the incremental load, from the arrivals' span (two scalars)."""
    lo, hi = spark.sql(PAYMENT_BOUNDS, raw_payments=raw_payments).first()
    return _divide(lo, hi, PAYMENT_RUNS)


def payment_run_sql(run: int) -> str:
    """Run date for the oracle (CTE ``payment_bounds``); run 0 is before everything."""
    if run == 0:
        return "date '0001-01-01'"
    return f"(select lo + cast((hi - lo) * {run} // {PAYMENT_RUNS} as integer) from payment_bounds)"


PAYMENT_MONTH = "payment_month"


def land_payments(raw_payments: DataFrame, path: str) -> DataFrame:
    """Write the payment source by month of payment (unpaid rows are the NULL month) and read it back.

    Rows are dealt by ranges of month and key: a month is a few files, a month that
    holds most rows many.
    """
    dated = raw_payments.withColumn(PAYMENT_MONTH, F.trunc("payment_date", "month"))
    (dated.repartitionByRange(PAYMENT_MONTH, "payment_id").write.mode("overwrite")
     .partitionBy(PAYMENT_MONTH).parquet(path))
    return raw_payments.sparkSession.read.schema(dated.schema).parquet(path)


def payment_source(spark: SparkSession, raw_payments: DataFrame, run_date: dt.date,
                   since: dt.date | None = None) -> DataFrame:
    """The payment source as of a run date; with ``since`` (of a landed source) at least its
    payments dated on or after that day. Corrections only move a payment to an earlier day, so
    such payments were landed in that day's month or a later one: the others are not read."""
    rows = raw_payments if since is None else raw_payments.where(F.col(PAYMENT_MONTH) >= F.lit(since.replace(day=1)))
    return spark.sql(PAYMENT_SOURCE.replace("{run_date}", _date(run_date)), raw_payments=rows)


def payment_source_sql(run: int) -> str:
    return PAYMENT_SOURCE.replace("{run_date}", payment_run_sql(run)).replace("{raw_payments}", "raw_payments")


def payment_changes_between(spark: SparkSession, raw_payments: DataFrame, from_date: dt.date | None,
                            run_date: dt.date) -> DataFrame:
    sql = PAYMENT_CHANGES.replace("{run_date}", _date(run_date)).replace(
        "{from_date}", _date(from_date or dt.date(1, 1, 1)))
    return spark.sql(sql, raw_payments=raw_payments)


def repeated_payments(raw_payments: DataFrame) -> DataFrame:
    """Keys that several rows share."""
    counted = raw_payments.where("payment_id is not null").groupBy("payment_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1").select("payment_id")


def payment_delivery(spark: SparkSession, raw_payments: DataFrame, from_date: dt.date | None, run_date: dt.date,
                     repeated: DataFrame) -> DataFrame:
    """The source rows, as of ``run_date``, of the keys that appeared or were corrected since ``from_date``.

    A row that changed is found by looking at it: it arrived, or was corrected a day later,
    since ``from_date``, so of a landed source (:func:`land_payments`) only the months around
    that time and the unpaid rows are read. Other rows follow only if their key is among the
    ``repeated`` ones and another row of it changed: only those are joined.
    """
    def rows(which: str, raw_payments: DataFrame) -> DataFrame:
        sql = (PAYMENT_CHANGED.replace("{which}", which).replace("{run_date}", _date(run_date))
               .replace("{from_date}", _date(from_date or dt.date(1, 1, 1))))
        return spark.sql(sql, raw_payments=raw_payments)

    near = raw_payments
    if PAYMENT_MONTH in raw_payments.columns:  # a payment arrives at most ARRIVAL_DAYS from its day
        month = F.col(PAYMENT_MONTH)
        around = month <= F.date_add(F.lit(run_date), ARRIVAL_DAYS)
        if from_date:
            around &= month >= F.trunc(F.date_sub(F.lit(from_date), ARRIVAL_DAYS + 1), "month")
        near = raw_payments.where(around | month.isNull())
    changed, others = rows("", near), rows("not", raw_payments)
    shared = changed.select("payment_id").join(repeated, "payment_id", "left_semi")
    return changed.unionByName(others.join(repeated, "payment_id", "left_semi").join(shared, "payment_id", "left_semi"))


def payment_changes_sql(run: int) -> str:
    return PAYMENT_CHANGES.replace("{run_date}", payment_run_sql(run)).replace(
        "{from_date}", payment_run_sql(run - 1)).replace("{raw_payments}", "raw_payments")
