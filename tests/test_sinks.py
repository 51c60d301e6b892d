"""Deployment sinks (views, tables, database routing) and typed seed CSVs."""

import datetime as dt
import os
import tempfile

from loanmart.sources import seeds


def test_read_seed_csv_crlf_utf8(spark):
    d = tempfile.mkdtemp(prefix="loanmart-seed-")
    p = os.path.join(d, "holidays.csv")
    with open(p, "wb") as f:
        f.write("date,holiday_name,holiday_type,is_bank_holiday\r\n"
                "2021-04-01,Semana Santa (jueves),observance,false\r\n"
                "2021-04-02,Día del Veterano,national,true\r\n".encode("utf-8"))
    df = seeds.read_seed_csv(spark, p, seeds.HOLIDAY_SCHEMA)
    got = sorted((r.date, r.holiday_name, r.is_bank_holiday) for r in df.collect())
    assert got == [(dt.date(2021, 4, 1), "Semana Santa (jueves)", False),
                   (dt.date(2021, 4, 2), "Día del Veterano", True)]


def test_build_views_tables_and_routing(spark):
    from conftest import SF_SMALL
    from loanmart.plans.build import build
    from loanmart.plans.models import Models

    m = Models(spark, SF_SMALL)
    out = build(m, database="lm_test")
    assert out["stg_payments"] == "stg_payments"
    assert out["dim_date"] == "`lm_test_core`.`dim_date`"
    assert out["bureau_history"] == "`lm_test_snapshots`.`scd_credit_bureau`"
    assert out["buckets"] == "`lm_test_seeds`.`catalog_delinquency_buckets`"
    agg = spark.table("lm_test.agg_customer_360")
    assert agg.count() == spark.table("lm_test.dim_customers").count()
    parts = spark.sql("show partitions lm_test.fct_payments").count()
    assert parts > 1
    assert spark.table("stg_payments").count() > 0


def test_build_runs_again(spark):
    """The same graph builds twice; the history gains a run and the payment fact merges."""
    from conftest import SF_SMALL
    from loanmart.plans.build import build
    from loanmart.plans.models import Models

    m = Models(spark, SF_SMALL)
    first, second = m.bureau_batches()[2], m.bureau_batches()[-1]
    early, late = m.payment_runs([3])[0], m.payment_runs([8])[0]
    only = ("bureau_history", "dim_products", "fct_payments", "fct_applications")
    build(m, "lm_again", bureau=first, payments=early, only=only)
    before = spark.table("lm_again.fct_payments").count()
    out = build(m, "lm_again", bureau=second, payments=late, only=only)
    runs = spark.table("lm_again_snapshots.scd_credit_bureau_runs")
    assert runs.select("snapshot_run").distinct().count() == 2
    history = spark.table(out["bureau_history"])
    assert history.where("dbt_valid_to is null").groupBy("customer_id").count().where("count > 1").count() == 0
    assert spark.table("lm_again.fct_payments").count() > before
    # a full refresh holds exactly the newest source
    build(m, "lm_again", full_refresh=True, bureau=second, payments=late, only=("fct_payments",))
    assert spark.table("lm_again.fct_payments").count() == late[0].count()
