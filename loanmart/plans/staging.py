"""Staging: one cleaned, typed view per raw table (projections only, no shuffles)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.columns import (days_between, flag, ladder_at_least, mask_pii, money,
                                        rate)
from loanmart.params import DEFAULT, RunParams

# --- fixed values (must equal the reference's for equal results) -----------
# Four-level bureau score tier used in staging (score >= threshold).
STAGING_SCORE_TIERS = [(750, "PRIME"), (650, "NEAR_PRIME"), (550, "SUBPRIME")]
STAGING_SCORE_ELSE = "DEEP_SUBPRIME"
# ---------------------------------------------------------------------------


def _stamp(p: RunParams):
    return F.lit(p.run_ts).cast("timestamp").alias("dbt_loaded_at")


def stg_customers(raw: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    m = p.mask_pii
    first = mask_pii("first_name", "name", m)
    last = mask_pii("last_name", "name", m)
    return raw.select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        mask_pii("email", "email", m).alias("email"),
        mask_pii(F.col("phone").cast("string"), "phone", m).alias("phone"),
        "city",
        mask_pii("birth_date", "birth_date", m).alias("birth_date"),
        money("monthly_income_ars").alias("monthly_income_ars"),
        "employment_status",
        "customer_segment",
        F.col("signup_date").cast("date").alias("signup_date"),
        "account_status",
        F.col("updated_at").cast("timestamp").alias("source_updated_at"),
        _stamp(p),
    )


def stg_applications(raw: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    app_d = F.col("application_date").cast("date")
    dec_d = F.col("decision_date").cast("date")
    status = F.col("application_status")
    return raw.select(
        "application_id",
        "customer_id",
        "product_code",
        money("requested_amount_ars").alias("requested_amount_ars"),
        "channel",
        "application_status",
        app_d.alias("application_date"),
        dec_d.alias("decision_date"),
        F.when(dec_d.isNotNull(), days_between(dec_d, app_d)).alias("days_to_decision"),
        flag(status == "approved").alias("is_approved"),
        flag(status == "rejected").alias("is_rejected"),
        flag(status == "pending").alias("is_pending"),
        _stamp(p),
    )


def monthly_installment(amount, term, annual_rate_pct):
    """round(amount / term * (1 + annual_rate / 100 / 12), 2), NULL when term <= 0.

    Written as one exact decimal division, amount * (1200 + rate) / (1200 * term),
    so no intermediate result is rounded before the final 2-digit rounding.
    """
    num = amount * (F.lit(1200).cast("decimal(4,0)") + annual_rate_pct)
    den = (term * F.lit(1200)).cast("decimal(20,0)")
    return F.when(term > 0, F.round(num / den, 2))


def stg_originations(raw: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    amount = money("approved_amount_ars")
    term = F.col("term_months").cast("bigint")
    annual = rate("annual_interest_rate_pct")
    orig_d = F.col("origination_date").cast("date")
    return raw.select(
        "origination_id",
        "application_id",
        "customer_id",
        "product_code",
        amount.alias("approved_amount_ars"),
        term.alias("term_months"),
        annual.alias("annual_interest_rate_pct"),
        F.round(annual / F.lit(12).cast("decimal(2,0)"), 4).cast("decimal(9,4)").alias("monthly_interest_rate_pct"),
        monthly_installment(amount, term, annual).cast("decimal(18,2)").alias("estimated_monthly_installment_ars"),
        orig_d.alias("origination_date"),
        F.col("first_payment_due_date").cast("date").alias("first_payment_due_date"),
        F.date_format(orig_d, "yyyy-MM").alias("origination_cohort"),
        _stamp(p),
    )


def stg_payments(raw: DataFrame, p: RunParams = DEFAULT, carry: tuple[str, ...] = ()) -> DataFrame:
    """``carry``: extra input columns passed through unchanged (e.g. a delivery time)."""
    due_d = F.col("due_date").cast("date")
    pay_d = F.col("payment_date").cast("date")
    paid = money("paid_amount_ars")
    due = money("due_amount_ars")
    return raw.select(
        "payment_id",
        "origination_id",
        "customer_id",
        F.col("installment_number").cast("bigint").alias("installment_number"),
        due_d.alias("due_date"),
        pay_d.alias("payment_date"),
        due.alias("due_amount_ars"),
        paid.alias("paid_amount_ars"),
        F.round(paid - due, 2).cast("decimal(18,2)").alias("payment_variance_ars"),
        "payment_method",
        days_between(pay_d, due_d).alias("days_past_due"),
        flag(pay_d <= due_d).alias("is_on_time_payment"),
        *carry,
        _stamp(p),
    )


def stg_credit_bureau(raw: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return raw.select(
        "customer_id",
        F.col("bureau_score").cast("bigint").alias("bureau_score"),
        F.col("active_debts_count").cast("bigint").alias("active_debts_count"),
        money("total_debt_ars").alias("total_debt_ars"),
        F.col("delinquencies_last_12m").cast("bigint").alias("delinquencies_last_12m"),
        F.col("has_default_history").cast("boolean").alias("has_default_history"),
        ladder_at_least("bureau_score", STAGING_SCORE_TIERS, STAGING_SCORE_ELSE).alias("bureau_risk_tier"),
        F.col("report_date").cast("date").alias("report_date"),
        _stamp(p),
    )
