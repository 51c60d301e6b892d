"""Golden micro-tests at the threshold edges of every ladder and join rule."""

import datetime as dt
from decimal import Decimal


from loanmart.params import RunParams
from loanmart.plans import customer360 as c360
from loanmart.plans import dims, intermediate, staging
from loanmart.sources import seeds

D = dt.date


def payments_df(spark, dpds):
    rows = []
    for i, dpd in enumerate(dpds):
        due = D(2024, 1, 10)
        pay = None if dpd is None else due + dt.timedelta(days=dpd)
        rows.append((f"p{i}", 1, 1, 1, due, pay, Decimal("100.00"), Decimal("90.00"), "cash"))
    return spark.createDataFrame(rows, "payment_id string, origination_id bigint, customer_id bigint, "
                                       "installment_number int, due_date date, payment_date date, "
                                       "due_amount_ars decimal(18,2), paid_amount_ars decimal(18,2), "
                                       "payment_method string")


def test_bucket_edges_and_drops(spark):
    dpds = [-1, 0, 1, 29, 30, 59, 60, 89, 90, 179, 180, 9999, 10000, None]
    stg = staging.stg_payments(payments_df(spark, dpds))
    out = intermediate.payments_bucketed(stg, seeds.delinquency_buckets(spark))
    got = {r.days_past_due: (r.bucket_code, r.is_delinquent_payment) for r in out.collect()}
    assert got == {
        0: ("CURRENT", False), 1: ("B1_29", True), 29: ("B1_29", True), 30: ("B30_59", True),
        59: ("B30_59", True), 60: ("B60_89", True), 89: ("B60_89", True), 90: ("B90_PLUS", True),
        179: ("B90_PLUS", True), 180: ("DEFAULT", True), 9999: ("DEFAULT", True)}
    # early (-1), beyond the last band (10000) and unpaid (NULL) have no bucket: dropped


def test_bucket_join_shuffle_fallback_matches_broadcast(spark):
    dpds = list(range(-3, 400, 7)) + [None, 9999, 10000]
    stg = staging.stg_payments(payments_df(spark, dpds))
    b = seeds.delinquency_buckets(spark)
    small = intermediate.payments_bucketed(stg, b, RunParams())
    big = intermediate.payments_bucketed(stg, b, RunParams(max_broadcast_rows=2), bucket_rows=None)
    key = ("payment_id", "bucket_code")
    assert sorted(tuple(r[k] for k in key) for r in small.collect()) == \
        sorted(tuple(r[k] for k in key) for r in big.collect())
    assert "BroadcastNestedLoopJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_on_time_and_variance(spark):
    stg = staging.stg_payments(payments_df(spark, [-2, 0, 3, None])).collect()
    m = {r.days_past_due: r for r in stg}
    assert m[-2].is_on_time_payment and m[0].is_on_time_payment
    assert not m[3].is_on_time_payment and not m[None].is_on_time_payment
    assert m[0].payment_variance_ars == Decimal("-10.00")


def test_staging_score_tier_edges(spark):
    rows = [(i, s, 1, Decimal("1.00"), 0, False, D(2024, 1, 5))
            for i, s in enumerate([549, 550, 649, 650, 749, 750, None])]
    raw = spark.createDataFrame(rows, "customer_id bigint, bureau_score bigint, active_debts_count bigint, "
                                      "total_debt_ars decimal(18,2), delinquencies_last_12m bigint, "
                                      "has_default_history boolean, report_date date")
    got = {r.bureau_score: r.bureau_risk_tier for r in staging.stg_credit_bureau(raw).collect()}
    assert got == {549: "DEEP_SUBPRIME", 550: "SUBPRIME", 649: "SUBPRIME", 650: "NEAR_PRIME",
                   749: "NEAR_PRIME", 750: "PRIME", None: "DEEP_SUBPRIME"}


def test_originations_instalment_and_rate(spark):
    raw = spark.createDataFrame(
        [(1, 1, 1, "PERSONAL_LOAN", Decimal("1200.00"), 12, Decimal("60.00"), D(2024, 1, 3), D(2024, 2, 3)),
         (2, 2, 1, "CREDIT_CARD", Decimal("500.00"), 0, Decimal("30.50"), D(2024, 1, 3), D(2024, 2, 3))],
        "origination_id bigint, application_id bigint, customer_id bigint, product_code string, "
        "approved_amount_ars decimal(18,2), term_months bigint, annual_interest_rate_pct decimal(9,2), "
        "origination_date date, first_payment_due_date date")
    got = {r.origination_id: r for r in staging.stg_originations(raw).collect()}
    assert got[1].estimated_monthly_installment_ars == Decimal("105.00")  # 100 * (1 + 0.05)
    assert got[1].monthly_interest_rate_pct == Decimal("5.0000")
    assert got[2].estimated_monthly_installment_ars is None  # term 0
    assert got[2].monthly_interest_rate_pct == Decimal("2.5417")
    assert got[1].origination_cohort == "2024-01"


def _stg_customers(spark, incomes_births):
    rows = [(i, "Ana", "Diaz", "a@b.c", 5400000001, "X", b, inc, "emp", "A", D(2020, 1, 1), "active",
             dt.datetime(2024, 1, 1)) for i, (inc, b) in enumerate(incomes_births)]
    raw = spark.createDataFrame(rows, "customer_id bigint, first_name string, last_name string, email string, "
                                      "phone bigint, city string, birth_date date, monthly_income_ars decimal(18,2), "
                                      "employment_status string, customer_segment string, signup_date date, "
                                      "account_status string, updated_at timestamp")
    return staging.stg_customers(raw)


def _empty_history(spark):
    from loanmart.operators import scd2
    b = spark.createDataFrame([], "customer_id bigint, bureau_score bigint, total_debt_ars decimal(18,2), "
                                  "active_debts_count bigint, delinquencies_last_12m bigint, "
                                  "has_default_history boolean, report_date timestamp")
    return scd2.empty_history(b, "customer_id", "report_date")


def test_dim_customer_age_and_income_ladders(spark):
    p = RunParams(as_of=D(2024, 2, 1))
    cases = [(Decimal("499999.99"), D(2000, 6, 1)),   # age 24 -> 18-24, LOW
             (Decimal("500000"), D(1999, 6, 1)),       # age 25 -> 25-34, MID
             (Decimal("1499999"), D(1980, 6, 1)),      # 44 -> 35-44, MID
             (Decimal("1500000"), D(1970, 1, 1)),      # 54 -> 45-54, HIGH
             (Decimal("3000000"), D(1969, 12, 31)),    # 55 -> 55+, PREMIUM
             (None, None)]                             # null income -> PREMIUM, null age -> 55+
    stg = _stg_customers(spark, cases)
    enriched = intermediate.customers_enriched(stg, _empty_history(spark), p)
    got = {r.customer_id: (r.age_years, r.age_group, r.income_tier, r.bureau_risk_tier, r.has_bureau_report)
           for r in dims.dim_customers(enriched, p).collect()}
    assert got == {0: (24, "18-24", "LOW", None, False), 1: (25, "25-34", "MID", None, False),
                   2: (44, "35-44", "MID", None, False), 3: (54, "45-54", "HIGH", None, False),
                   4: (55, "55+", "PREMIUM", None, False), 5: (None, "55+", "PREMIUM", None, False)}


def test_enriched_score_tiers_and_dti(spark):
    from loanmart.operators import scd2
    p = RunParams(as_of=D(2024, 2, 1))
    stg = _stg_customers(spark, [(Decimal("1000.00"), D(1990, 1, 1))] * 4 + [(Decimal("0"), D(1990, 1, 1))])
    b = spark.createDataFrame(
        [(0, 649, Decimal("1200.00"), 1, 0, False, dt.datetime(2024, 1, 5)),
         (1, 650, None, 1, 0, False, dt.datetime(2024, 1, 5)),
         (2, 750, Decimal("600.00"), 1, 0, True, dt.datetime(2024, 1, 5)),
         (4, 300, Decimal("10.00"), 1, 0, False, dt.datetime(2024, 1, 5))],
        "customer_id bigint, bureau_score bigint, total_debt_ars decimal(18,2), active_debts_count bigint, "
        "delinquencies_last_12m bigint, has_default_history boolean, report_date timestamp")
    h = scd2.initial_history(b, "customer_id", "report_date")
    got = {r.customer_id: (r.bureau_risk_tier, r.debt_to_annual_income_ratio, r.has_bureau_report)
           for r in intermediate.customers_enriched(stg, h, p).collect()}
    assert got[0] == ("HIGH_RISK", Decimal("0.1000"), True)
    assert got[1] == ("MEDIUM_RISK", None, True)   # no debt -> no ratio
    assert got[2] == ("LOW_RISK", Decimal("0.0500"), True)
    assert got[3] == (None, None, False)           # no report
    assert got[4] == ("HIGH_RISK", None, True)     # income 0 -> no ratio


def test_dim_date_reference_calendar(spark):
    out = dims.dim_date(dims.calendar_bounds(spark))
    assert out.count() == 4018
    r = {x.date: x for x in out.where("date in ('2021-04-01','2021-04-02','2024-01-07','2024-03-31',"
                                      "'2020-12-31','2024-02-12','2024-02-13')").collect()}
    # two holidays on 2021-04-02: the first by name is kept
    assert r[D(2021, 4, 2)].holiday_name.startswith("Día del Veterano")
    # an observance is a holiday but stays a business day
    assert r[D(2021, 4, 1)].is_holiday and not r[D(2021, 4, 1)].is_bank_holiday
    assert r[D(2021, 4, 1)].is_business_day
    assert r[D(2024, 2, 12)].holiday_name == "Carnaval" and not r[D(2024, 2, 12)].is_business_day
    sun = r[D(2024, 1, 7)]
    assert (sun.day_of_week_number, sun.day_name, sun.day_name_short, sun.week_of_year) == (1, "Domingo", "Dom", 1)
    assert sun.week_start_date == D(2024, 1, 1) and sun.week_end_date == D(2024, 1, 7)
    assert sun.is_weekend and not sun.is_business_day and sun.date_sk == 20240107
    q = r[D(2024, 3, 31)]
    assert q.is_quarter_end and q.is_month_end and not q.is_year_end and q.quarter_name == "Q1"
    assert q.month_name == "Marzo" and q.month_short == "Mar" and q.year_quarter == "2024-Q1"
    assert r[D(2020, 12, 31)].is_year_end


def test_customer_360_rules(spark):
    dim = spark.createDataFrame(
        [(1, "active"), (2, "active"), (3, "blocked"), (4, "active")], "customer_id bigint, account_status string")
    for c in ["full_name", "age_group", "city", "customer_segment", "income_tier", "bureau_risk_tier"]:
        from pyspark.sql import functions as F
        dim = dim.withColumn(c, F.lit(None).cast("string"))
    from pyspark.sql import functions as F
    for c, t in [("age_years", "bigint"), ("monthly_income_ars", "decimal(18,2)"), ("days_since_signup", "bigint"),
                 ("has_bureau_report", "boolean"), ("bureau_score", "bigint"),
                 ("debt_to_annual_income_ratio", "decimal(18,4)"), ("has_default_history", "boolean")]:
        dim = dim.withColumn(c, F.lit(None).cast(t))
    apps = spark.createDataFrame([(1, True, False, False, D(2020, 1, 1)), (1, False, True, False, D(2020, 2, 1)),
                                  (2, True, False, False, D(2020, 1, 1)), (3, True, False, False, D(2020, 1, 1))],
                                 "customer_id bigint, is_approved boolean, is_rejected boolean, is_pending boolean, "
                                 "application_date date")
    origs = spark.createDataFrame([(1, Decimal("10.00"), Decimal("30.5000"), D(2020, 1, 5)),
                                   (3, Decimal("20.00"), Decimal("40.0000"), D(2020, 1, 5))],
                                  "customer_id bigint, approved_amount_ars decimal(18,2), "
                                  "annual_interest_rate_pct decimal(9,4), origination_date date")
    pays = spark.createDataFrame([(1, True, False, 0, 1), (1, False, True, 30, 3), (3, True, False, 0, 1)],
                                 "customer_id bigint, is_on_time_payment boolean, is_delinquent_payment boolean, "
                                 "days_past_due bigint, severity_order bigint")
    got = {r.customer_id: r for r in c360.customer_360(dim, apps, origs, pays).collect()}
    assert got[1].approval_rate == 0.5 and got[1].take_rate == 1.0
    assert got[1].current_risk_status == "MEDIUM_RISK" and got[1].on_time_payment_rate == 0.5
    assert got[2].take_rate is None  # approved, never originated: NULL not 0
    assert got[2].current_risk_status == "NO_HISTORY" and got[2].total_payments == 0
    assert got[3].current_risk_status == "CURRENT" and not got[3].is_healthy_active_customer  # blocked
    assert got[4].approval_rate is None and got[4].total_applications == 0
    assert got[1].total_credit_granted_ars == Decimal("10.00") and got[4].total_credit_granted_ars == 0


def test_many_and_open_ended_bands(spark):
    from pyspark.sql import functions as F

    from loanmart.operators.range_join import range_join

    n = 200_000
    bands = spark.range(n).selectExpr("id as band", "id * 10 as lo", "id * 10 + 9 as hi").union(
        spark.createDataFrame([(-1, 5, 2**62)], "band bigint, lo bigint, hi bigint"))
    values = spark.createDataFrame([(v,) for v in (-3, 0, 4, 5, 19, 1_999_999, 2_000_000, None)], "v bigint")
    out = range_join(values, F.col("v"), bands, "lo", "hi", max_broadcast_rows=100_000)
    got = sorted((r.v, r.band) for r in out.collect())
    assert got == [(0, 0), (4, 0), (5, -1), (5, 0), (19, -1), (19, 1), (1_999_999, -1), (1_999_999, 199_999), (2_000_000, -1)]
    left = range_join(values, F.col("v"), bands, "lo", "hi", how="left", max_broadcast_rows=100_000)
    assert sorted(str(r.v) for r in left.where("band is null").collect()) == ["-3", "None"]
