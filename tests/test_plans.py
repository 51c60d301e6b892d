"""Physical-plan properties the design relies on (read from explain output)."""

import contextlib
import io
import datetime as dt
import re

from conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def static_plans(spark):
    """AQE and automatic broadcast off: the plan as planned, without runtime rewrites."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def restore(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_customer_360_one_exchange_per_input(spark):
    from loanmart.plans.models import Models
    m = Models(spark, SF_SMALL)
    df = m.customer_360
    static_plans(spark)
    try:
        p = plan(df, "simple")
    finally:
        restore(spark)
    # customers, current bureau versions and the three per-customer aggregates are
    # each hash-partitioned on customer_id once; the joins reuse that partitioning
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\)", p)) == 5
    assert p.count("SortMergeJoin") >= 4
    # every summary is partially aggregated before its exchange
    assert len(re.findall(r"HashAggregate\(keys=\[customer_id#\d+L?\], functions=\[partial_", p)) == 3
    # the bucket lookup is broadcast into a nested-loop range join
    assert "BroadcastNestedLoopJoin" in p


def test_payment_summary_prunes_scan_columns(spark):
    from loanmart.plans import customer360 as c360
    from loanmart.plans.models import Models
    m = Models(spark, SF_SMALL)
    p = plan(c360.payments_summary(m.fct_payments))
    li = [line for line in p.splitlines() if line.startswith("ReadSchema") and "l_orderkey" in line]
    assert li, p
    # the summary needs no amounts, tax, discount or flags from lineitem
    assert "l_extendedprice" not in li[0] and "l_discount" not in li[0] and "l_tax" not in li[0]


def test_bureau_day_filter_reaches_scan(spark):
    from loanmart.sources import batches
    from loanmart.sources.raw_fixtures import RawTables
    raw = RawTables(spark, SF_SMALL)
    p = plan(batches.bureau_batch(spark, raw.bureau_feed, dt.date(2024, 1, 10), None))
    assert re.search(r"PushedFilters: \[.*LessThan\(ts,2024-01-11", p), p


def test_history_split_pushes_validity_filters(spark):
    import datetime as dt

    from loanmart.operators import scd2
    from loanmart.session import materialize
    b = spark.createDataFrame([(1, 500, dt.datetime(2024, 1, 1))],
                              "customer_id bigint, bureau_score bigint, report_date timestamp")
    h = materialize(scd2.initial_history(b, "customer_id", "report_date"), "plan_test")
    p = plan(scd2.merge(h, b, "customer_id", "report_date", dt.datetime(2024, 1, 2)))
    assert "PushedFilters: [IsNotNull(dbt_valid_to)]" in p  # closed versions: no shuffle
    assert "PushedFilters: [IsNull(dbt_valid_to)" in p     # open versions: joined with the batch


def test_no_python_udfs_in_models(spark):
    from loanmart import registry as R
    for key in ["customer_360", "dim_date", "payments_bucketed", "dq_report"]:
        p = plan(R.QUERIES[key](spark, SF_SMALL), "simple")
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_lookback_reads_recent_months_only(spark):
    from pyspark.sql import functions as F

    from loanmart import registry as R
    m = R._models(spark, SF_SMALL)
    feed, _ = m.payment_feeds([8])[0]
    last = m.payment_run_dates[-1]
    files = {}
    for since in (None, last - dt.timedelta(days=900), last - dt.timedelta(days=100)):
        df = feed(since)
        p = plan(df)
        pruned = re.search(r"PartitionFilters: \[[^\]]*payment_month[^\]]*>= ", p)
        assert bool(pruned) == (since is not None), p
        read = m.payment_source_table if since is None else m.payment_source_table.where(F.col("payment_month") >= F.lit(since.replace(day=1)))
        files[since] = read.select(F.input_file_name().alias("f")).distinct().count()
        if since is not None:  # nothing wanted is pruned
            want = feed(None).where(F.col("payment_date") >= F.lit(since))
            assert want.exceptAll(df).count() == 0 and df.where(F.col("payment_date") >= F.lit(since)).count() == want.count()
    counts = list(files.values())
    assert counts[0] > counts[1] > counts[2] > 0


def test_calendar_bounds_write_no_table(spark):
    from loanmart.plans.models import Models
    m = Models(spark, SF_SMALL)
    p = plan(m.calendar_bounds)
    assert "payment_source_table" not in m.__dict__ and "payment_method" not in p.split("ReadSchema")[-1]
