"""Customer 360: three per-customer summaries joined to the customer dimension.

Each fact is aggregated to one row per customer *before* joining (map-side
partial aggregation absorbs hot customers; no row fan-out). The three
summaries and the dimension are all hash-partitioned on ``customer_id``, so
the three left joins reuse that partitioning (one exchange per input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.columns import avg_exact, count_if_true, first_match
from loanmart.params import DEFAULT, RunParams

# --- fixed values (must equal the reference's for equal results) -----------
# Risk status from the worst days past due (checked in this order).
RISK_STATUS_DPD = [(180, "DEFAULT"), (90, "HIGH_RISK"), (30, "MEDIUM_RISK"), (1, "LOW_RISK")]
RISK_STATUS_CURRENT = "CURRENT"
RISK_STATUS_NO_HISTORY = "NO_HISTORY"
# ---------------------------------------------------------------------------


def apps_summary(fct_applications: DataFrame) -> DataFrame:
    return fct_applications.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_applications"),
        count_if_true("is_approved").alias("approved_applications"),
        count_if_true("is_rejected").alias("rejected_applications"),
        count_if_true("is_pending").alias("pending_applications"),
        F.min("application_date").alias("first_application_date"),
        F.max("application_date").alias("last_application_date"),
    )


def originations_summary(fct_originations: DataFrame) -> DataFrame:
    return fct_originations.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_originations"),
        F.sum("approved_amount_ars").alias("total_credit_granted_ars"),
        avg_exact("approved_amount_ars").alias("avg_ticket_ars"),
        avg_exact("annual_interest_rate_pct").alias("avg_interest_rate_pct"),
        F.min("origination_date").alias("first_origination_date"),
        F.max("origination_date").alias("last_origination_date"),
    )


def payments_summary(fct_payments: DataFrame) -> DataFrame:
    return fct_payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_payments"),
        count_if_true("is_on_time_payment").alias("on_time_payments"),
        count_if_true("is_delinquent_payment").alias("delinquent_payments"),
        F.avg("days_past_due").alias("avg_days_past_due"),
        F.max("days_past_due").alias("max_days_past_due"),
        F.max("severity_order").alias("worst_bucket_ever"),
    )


def customer_360(dim_customers: DataFrame, fct_applications: DataFrame,
                 fct_originations: DataFrame, fct_payments: DataFrame,
                 p: RunParams = DEFAULT) -> DataFrame:
    return from_summaries(dim_customers, apps_summary(fct_applications), originations_summary(fct_originations),
                          payments_summary(fct_payments), p)


def from_summaries(dim_customers: DataFrame, applications: DataFrame, originations: DataFrame,
                   payments: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """The customer 360 of a dimension and the three summaries, one row per customer each."""
    c = dim_customers.alias("c")
    a, o, pay = applications.alias("a"), originations.alias("o"), payments.alias("p")
    cid = F.col("c.customer_id")
    j = (c.join(a, cid == F.col("a.customer_id"), "left")
         .join(o, cid == F.col("o.customer_id"), "left")
         .join(pay, cid == F.col("p.customer_id"), "left"))

    def z(col):
        return F.coalesce(F.col(col), F.lit(0))

    max_dpd = F.col("p.max_days_past_due")
    return j.select(
        cid.alias("customer_id"),
        "c.full_name", "c.age_years", "c.age_group", "c.city", "c.customer_segment",
        "c.income_tier", "c.monthly_income_ars", "c.account_status", "c.days_since_signup",
        "c.has_bureau_report", "c.bureau_score", "c.bureau_risk_tier",
        "c.debt_to_annual_income_ratio", "c.has_default_history",
        z("a.total_applications").alias("total_applications"),
        z("a.approved_applications").alias("approved_applications"),
        z("a.rejected_applications").alias("rejected_applications"),
        F.when(z("a.total_applications") > 0,
               F.round(F.col("a.approved_applications") / F.col("a.total_applications"), 4))
        .alias("approval_rate"),
        z("o.total_originations").alias("total_originations"),
        F.coalesce(F.col("o.total_credit_granted_ars"), F.lit(0).cast("decimal(28,2)"))
        .alias("total_credit_granted_ars"),
        "o.avg_ticket_ars", "o.avg_interest_rate_pct", "o.first_origination_date",
        "o.last_origination_date",
        # numerator not coalesced: approvals without an origination give NULL
        F.when(z("a.approved_applications") > 0,
               F.round(F.col("o.total_originations") / F.col("a.approved_applications"), 4))
        .alias("take_rate"),
        z("p.total_payments").alias("total_payments"),
        z("p.on_time_payments").alias("on_time_payments"),
        z("p.delinquent_payments").alias("delinquent_payments"),
        F.when(z("p.total_payments") > 0,
               F.round(F.col("p.on_time_payments") / F.col("p.total_payments"), 4))
        .alias("on_time_payment_rate"),
        "p.avg_days_past_due", "p.max_days_past_due",
        first_match([(max_dpd >= t, s) for t, s in RISK_STATUS_DPD]
                    + [(F.col("p.total_payments") > 0, RISK_STATUS_CURRENT)],
                    RISK_STATUS_NO_HISTORY).alias("current_risk_status"),
        F.when((z("o.total_originations") > 0) & (z("p.delinquent_payments") == 0)
               & (F.col("c.account_status") == "active"), F.lit(True))
        .otherwise(F.lit(False)).alias("is_healthy_active_customer"),
        F.lit(p.run_ts).cast("timestamp").alias("dbt_updated_at"),
    )
