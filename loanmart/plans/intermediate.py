"""Intermediate models: enrichment joins on the staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.calendar import year_boundaries_between
from loanmart.functions.columns import days_between, first_match, flag
from loanmart.operators import scd2
from loanmart.operators.range_join import range_join
from loanmart.params import DEFAULT, RunParams

# --- fixed values (must equal the reference's for equal results) -----------
# Three-level risk tier from the current bureau score (score >= threshold).
ENRICHED_SCORE_TIERS = [(750, "LOW_RISK"), (650, "MEDIUM_RISK")]
ENRICHED_SCORE_ELSE = "HIGH_RISK"
# ---------------------------------------------------------------------------

BUREAU_COLUMNS = ["customer_id", "bureau_score", "total_debt_ars", "active_debts_count",
                  "delinquencies_last_12m", "has_default_history"]


def bureau_current(history: DataFrame) -> DataFrame:
    """Open version per customer from the type-2 bureau history."""
    return scd2.current(history).select(*BUREAU_COLUMNS)


def customers_enriched(stg_customers: DataFrame, bureau_history: DataFrame,
                       p: RunParams = DEFAULT) -> DataFrame:
    """Customer profile joined to the current bureau report (left join on customer_id)."""
    c = stg_customers.alias("c")
    b = bureau_current(bureau_history).alias("b")
    today = F.lit(p.as_of).cast("date")
    score = F.col("b.bureau_score")
    income = F.col("c.monthly_income_ars")
    debt = F.col("b.total_debt_ars")
    return c.join(b, F.col("c.customer_id") == F.col("b.customer_id"), "left").select(
        F.col("c.customer_id").alias("customer_id"),
        "c.full_name", "c.email", "c.city", "c.birth_date",
        year_boundaries_between(today, F.col("c.birth_date")).alias("age_years"),
        "c.monthly_income_ars", "c.employment_status", "c.customer_segment", "c.signup_date",
        days_between(today, F.col("c.signup_date")).alias("days_since_signup"),
        "c.account_status",
        score.alias("bureau_score"),
        first_match([(score.isNull(), None)] + [(score >= t, lab) for t, lab in ENRICHED_SCORE_TIERS],
                    ENRICHED_SCORE_ELSE).alias("bureau_risk_tier"),
        "b.active_debts_count", "b.total_debt_ars", "b.delinquencies_last_12m",
        "b.has_default_history",
        flag(F.col("b.customer_id").isNotNull()).alias("has_bureau_report"),
        F.when(debt.isNotNull() & (income > 0),
               F.round(debt / (income * F.lit(12).cast("decimal(2,0)")), 4))
        .alias("debt_to_annual_income_ratio"),
        F.lit(p.run_ts).cast("timestamp").alias("dbt_loaded_at"),
    )


def applications_outcome(stg_applications: DataFrame, stg_originations: DataFrame,
                         p: RunParams = DEFAULT) -> DataFrame:
    """Each application with its origination, if any (left join on application_id)."""
    a = stg_applications.alias("a")
    o = stg_originations.alias("o")
    approved = F.col("o.approved_amount_ars")
    requested = F.col("a.requested_amount_ars")
    return a.join(o, F.col("a.application_id") == F.col("o.application_id"), "left").select(
        F.col("a.application_id").alias("application_id"),
        F.col("a.customer_id").alias("customer_id"),
        F.col("a.product_code").alias("product_code"),
        "a.requested_amount_ars", "a.channel", "a.application_status", "a.application_date",
        "a.decision_date", "a.days_to_decision", "a.is_approved", "a.is_rejected", "a.is_pending",
        "o.origination_id", "o.approved_amount_ars", "o.term_months", "o.annual_interest_rate_pct",
        "o.monthly_interest_rate_pct", "o.estimated_monthly_installment_ars", "o.origination_date",
        "o.first_payment_due_date", "o.origination_cohort",
        flag(F.col("o.origination_id").isNotNull()).alias("was_originated"),
        flag(F.col("a.is_approved") & F.col("o.origination_id").isNull()).alias("approved_not_taken"),
        F.when(F.col("o.origination_date").isNotNull() & F.col("a.decision_date").isNotNull(),
               days_between(F.col("o.origination_date"), F.col("a.decision_date")))
        .alias("days_decision_to_origination"),
        F.when(approved.isNotNull() & (requested > 0), F.round(approved / requested, 4))
        .alias("approval_ratio"),
        F.lit(p.run_ts).cast("timestamp").alias("dbt_loaded_at"),
    )


def payments_bucketed(stg_payments: DataFrame, buckets: DataFrame, p: RunParams = DEFAULT,
                      bucket_rows: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each payment classified into its days-past-due bucket (inner range join).

    Payments whose days past due fall in no bucket (early: negative; unpaid:
    NULL; beyond the last bucket) have no partner and are dropped. Without
    ``bucket_rows`` the bands are counted before one plan or the other is chosen.
    """
    joined = range_join(stg_payments.drop("dbt_loaded_at"), F.col("days_past_due"), buckets,
                        "dpd_min", "dpd_max", how="inner",
                        max_broadcast_rows=p.max_broadcast_rows, known_range_rows=bucket_rows)
    return joined.select(
        "payment_id", "origination_id", "customer_id", "installment_number",
        "due_date", "payment_date", "due_amount_ars", "paid_amount_ars", "payment_variance_ars",
        "payment_method", "days_past_due", "is_on_time_payment",
        "bucket_code", "bucket_name", "is_delinquent", "severity_order",
        flag(F.col("is_delinquent") == "Y").alias("is_delinquent_payment"),
        *carry,
        F.lit(p.run_ts).cast("timestamp").alias("dbt_loaded_at"),
    )
