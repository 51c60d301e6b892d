"""Portfolio measures named by the dashboard that consumes the marts.

The reference names these measures (risk distribution, delinquency rate and
mean days past due, roll rates, vintages by origination cohort, approval /
take rate / mean ticket by product, monthly score evolution, source
freshness) but ships no SQL for them; the definitions below are ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.functions.columns import avg_exact, count_if_true, first_match
from loanmart.operators.asof import asof_join
from loanmart.operators.broadcast import broadcast_if_small
from loanmart.params import DEFAULT, RunParams
from loanmart.plans.intermediate import ENRICHED_SCORE_ELSE, ENRICHED_SCORE_TIERS

# --- fixed values (must equal the reference's for equal results) -----------
# Source freshness targets in hours: (warn after, error after).
FRESHNESS_HOURS = {"raw_customers": (24, 48), "raw_applications": (6, 24)}
# ---------------------------------------------------------------------------


def _rate(num, den, scale=4):
    return F.when(den > 0, F.round(num / den, scale))


def portfolio_by_risk(customer_360: DataFrame) -> DataFrame:
    """Customers and exposure by segment, bureau tier and payment risk status."""
    return customer_360.groupBy("customer_segment", "bureau_risk_tier", "current_risk_status").agg(
        F.count(F.lit(1)).alias("customers"),
        count_if_true(F.col("total_originations") > 0).alias("customers_with_credit"),
        F.sum("total_credit_granted_ars").alias("total_credit_granted_ars"),
        F.sum("total_payments").alias("total_payments"),
        F.sum("delinquent_payments").alias("delinquent_payments"),
    )


def delinquency_monthly(fct_payments: DataFrame) -> DataFrame:
    """Delinquency rate and mean days past due by payment month."""
    g = fct_payments.groupBy(F.trunc("payment_date", "month").alias("payment_month")).agg(
        F.count(F.lit(1)).alias("payments"),
        count_if_true("is_delinquent_payment").alias("delinquent_payments"),
        F.avg("days_past_due").alias("avg_days_past_due"),
        F.sum("paid_amount_ars").alias("paid_amount_ars"),
    )
    return g.withColumn("delinquency_rate", _rate(F.col("delinquent_payments"), F.col("payments")))


def roll_rates(fct_payments: DataFrame) -> DataFrame:
    """Share of instalments moving from bucket A to bucket B at the next instalment.

    An instalment's bucket is the worst bucket among its payments, so each
    (origination, instalment) is one row before the consecutive-instalment
    join: the join is one-to-one on a near-unique composite key (no pairs
    within a group, no hot key).
    """
    inst = (fct_payments.groupBy("origination_id", "installment_number")
            .agg(F.max_by("bucket_code", "severity_order").alias("bucket_code")))
    nxt = inst.select("origination_id", (F.col("installment_number") - 1).alias("installment_number"),
                      F.col("bucket_code").alias("to_bucket"))
    pairs = inst.join(nxt, ["origination_id", "installment_number"], "inner")
    counts = pairs.groupBy(F.col("bucket_code").alias("from_bucket"), "to_bucket").agg(
        F.count(F.lit(1)).alias("transitions"))
    total = F.sum("transitions").over(Window.partitionBy("from_bucket"))
    return counts.withColumn("roll_rate", F.round(F.col("transitions") / total, 4))


def _month_index(d):
    return F.year(d) * 12 + F.month(d)


def vintage_cohort(fct_payments: DataFrame, fct_originations: DataFrame) -> DataFrame:
    """Payments and delinquency by origination cohort and months on book (due month).

    Payments are aggregated per (origination, due month) before joining the
    one-row-per-origination side, so a very large loan adds few join rows.
    """
    per_loan = (fct_payments.groupBy("origination_id", F.trunc("due_date", "month").alias("due_month"))
                .agg(F.count(F.lit(1)).alias("payments"),
                     count_if_true("is_delinquent_payment").alias("delinquent_payments")))
    o = fct_originations.select("origination_id", "origination_cohort", "origination_date")
    j = per_loan.join(o, "origination_id", "inner")
    mob = (_month_index(F.col("due_month")) - _month_index(F.col("origination_date"))).alias("months_on_book")
    g = j.groupBy("origination_cohort", mob).agg(
        F.sum("payments").alias("payments"), F.sum("delinquent_payments").alias("delinquent_payments"),
        F.count(F.lit(1)).alias("loan_months"))
    return g.withColumn("delinquency_rate", _rate(F.col("delinquent_payments"), F.col("payments")))


def product_funnel(fct_applications: DataFrame, fct_originations: DataFrame,
                   dim_products: DataFrame, product_rows: int | None = None,
                   max_broadcast_rows: int = 100_000) -> DataFrame:
    """Applications -> approvals -> originations by product, with mean ticket.

    The product dimension is broadcast when its row count (known for the
    seeded catalogue, else counted) is within ``max_broadcast_rows``.
    """
    a = fct_applications.groupBy("product_code").agg(
        F.count(F.lit(1)).alias("applications"),
        count_if_true("is_approved").alias("approved_applications"),
        count_if_true("was_originated").alias("originated_applications"),
        F.sum("requested_amount_ars").alias("requested_amount_ars"))
    o = fct_originations.groupBy("product_code").agg(
        F.count(F.lit(1)).alias("originations"),
        F.sum("approved_amount_ars").alias("granted_amount_ars"),
        avg_exact("approved_amount_ars").alias("avg_ticket_ars"))
    d, _ = broadcast_if_small(dim_products.select("product_code", "product_name", "product_type", "risk_tier"),
                              max_broadcast_rows, product_rows)
    j = a.join(o, "product_code", "full_outer").join(d, "product_code", "left")
    return j.select(
        "product_code", "product_name", "product_type", "risk_tier",
        F.coalesce("applications", F.lit(0)).alias("applications"),
        F.coalesce("approved_applications", F.lit(0)).alias("approved_applications"),
        F.coalesce("originations", F.lit(0)).alias("originations"),
        "requested_amount_ars", "granted_amount_ars", "avg_ticket_ars",
        _rate(F.col("approved_applications"), F.col("applications")).alias("approval_rate"),
        _rate(F.col("originated_applications"), F.col("approved_applications")).alias("take_rate"),
    )


def score_monthly(history: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """Bureau score by month end up to the month of ``p.as_of``: each customer's
    version valid at the end of the month.

    Every version is expanded to the month ends its validity can cover
    (bounded by its own length), then filtered exactly — no join, so the
    cost is linear in the history. Versions that start after that month are left out.
    """
    last = F.last_day(F.lit(p.as_of).cast("date"))
    end = F.least(F.to_date(F.coalesce("dbt_valid_to", last.cast("timestamp"))), last)
    month_starts = F.sequence(F.trunc(F.to_date("dbt_valid_from"), "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    history = history.where(F.to_date("dbt_valid_from") <= last)
    x = (history.select("customer_id", "bureau_score", "dbt_valid_from", "dbt_valid_to",
                        F.explode(month_starts).alias("month_start"))
         .withColumn("month_end", F.last_day("month_start")))
    at = F.to_timestamp(F.date_add("month_end", 1))  # the instant the month closes
    valid = x.where((F.col("dbt_valid_from") < at) & (F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") >= at)))
    score = F.col("bureau_score")
    tier = first_match([(score.isNull(), None)] + [(score >= t, lab) for t, lab in ENRICHED_SCORE_TIERS],
                       ENRICHED_SCORE_ELSE)
    return valid.groupBy("month_end", tier.alias("bureau_risk_tier")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("bureau_score").alias("avg_bureau_score"),
        F.min("bureau_score").alias("min_bureau_score"),
        F.max("bureau_score").alias("max_bureau_score"))


def application_bureau(reviews: DataFrame, history: DataFrame) -> DataFrame:
    """Every application with the bureau version that held at its ``review_ts`` (NULLs: none)."""
    return asof_join(reviews, history, "customer_id", "review_ts", "dbt_valid_from", "dbt_valid_to",
                     ["bureau_score", "total_debt_ars", "active_debts_count", "delinquencies_last_12m",
                      "has_default_history", "dbt_valid_from"])


def freshness(sources: dict[str, tuple[DataFrame, str]], p: RunParams = DEFAULT) -> DataFrame:
    """Hours since the newest load field of each source, against warn / error targets."""
    now = F.lit(p.run_ts).cast("timestamp")
    parts = []
    for name, (df, field) in sources.items():
        warn, err = FRESHNESS_HOURS[name]
        m = df.agg(F.max(F.col(field).cast("timestamp")).alias("max_loaded_at"))
        age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("max_loaded_at")) / 3600)
        parts.append(m.select(
            F.lit(name).alias("source"), "max_loaded_at", age.alias("age_hours"),
            F.lit(warn).cast("bigint").alias("warn_after_hours"),
            F.lit(err).cast("bigint").alias("error_after_hours"),
            F.when(age > err, "error").when(age > warn, "warn").otherwise("pass").alias("status")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


# --- registration ------------------------------------------------------------

def register_all(register, models, canonical) -> None:
    from loanmart import oracle as O

    O.cte("portfolio_by_risk", ("customer_360",), """
select customer_segment, bureau_risk_tier, current_risk_status, count(*) as customers,
  cast(sum(case when total_originations > 0 then 1 else 0 end) as bigint) as customers_with_credit,
  cast(sum(total_credit_granted_ars) as double) as total_credit_granted_ars,
  cast(sum(total_payments) as bigint) as total_payments,
  cast(sum(delinquent_payments) as bigint) as delinquent_payments
from customer_360 group by all""")

    @register("portfolio_by_risk", O.sql_for("select * from portfolio_by_risk", ("portfolio_by_risk",)))
    def q_portfolio(spark, sf_dir):
        return canonical(portfolio_by_risk(models(spark, sf_dir).customer_360))

    O.cte("delinquency_monthly", ("fct_payments",), f"""
select cast(date_trunc('month', payment_date) as date) as payment_month, count(*) as payments,
  cast(sum(case when is_delinquent_payment then 1 else 0 end) as bigint) as delinquent_payments,
  avg(days_past_due) as avg_days_past_due,
  cast(sum(paid_amount_ars) as double) as paid_amount_ars,
  {O.round_ratio('sum(case when is_delinquent_payment then 1 else 0 end)', 'count(*)', 4)} as delinquency_rate
from fct_payments group by 1""")

    @register("delinquency_monthly", O.sql_for("select * from delinquency_monthly", ("delinquency_monthly",)))
    def q_delinquency(spark, sf_dir):
        return canonical(delinquency_monthly(models(spark, sf_dir).fct_payments))

    O.cte("roll_rates", ("fct_payments",), f"""
with inst as (
  select origination_id, installment_number, arg_max(bucket_code, severity_order) as bucket_code
  from fct_payments group by 1, 2),
pairs as (
  select a.bucket_code as from_bucket, b.bucket_code as to_bucket, count(*) as transitions
  from inst a join inst b on a.origination_id = b.origination_id
   and b.installment_number = a.installment_number + 1
  group by 1, 2)
select from_bucket, to_bucket, transitions,
  {O.round_ratio('transitions', 'sum(transitions) over (partition by from_bucket)', 4)} as roll_rate
from pairs""")

    @register("roll_rates", O.sql_for("select * from roll_rates", ("roll_rates",)))
    def q_roll_rates(spark, sf_dir):
        return canonical(roll_rates(models(spark, sf_dir).fct_payments))

    O.cte("vintage_cohort", ("fct_payments", "fct_originations"), f"""
with per_loan as (
  select origination_id, cast(date_trunc('month', due_date) as date) as due_month, count(*) as payments,
    sum(case when is_delinquent_payment then 1 else 0 end) as delinquent_payments
  from fct_payments group by 1, 2)
select o.origination_cohort,
  (year(p.due_month) * 12 + month(p.due_month)) - (year(o.origination_date) * 12 + month(o.origination_date))
    as months_on_book,
  cast(sum(p.payments) as bigint) as payments,
  cast(sum(p.delinquent_payments) as bigint) as delinquent_payments,
  count(*) as loan_months,
  {O.round_ratio('sum(p.delinquent_payments)', 'sum(p.payments)', 4)} as delinquency_rate
from per_loan p join fct_originations o on p.origination_id = o.origination_id
group by 1, 2""")

    @register("vintage_cohort", O.sql_for("select * replace (cast(months_on_book as bigint) as months_on_book) "
                                          "from vintage_cohort", ("vintage_cohort",)))
    def q_vintage(spark, sf_dir):
        m = models(spark, sf_dir)
        return canonical(vintage_cohort(m.fct_payments, m.fct_originations))

    O.cte("product_funnel", ("fct_applications", "fct_originations", "dim_products_all"), f"""
with a as (
  select product_code, count(*) as applications,
    sum(case when is_approved then 1 else 0 end) as approved_applications,
    sum(case when was_originated then 1 else 0 end) as originated_applications,
    sum(requested_amount_ars) as requested_amount_ars
  from fct_applications group by 1),
o as (
  select product_code, count(*) as originations, sum(approved_amount_ars) as granted_amount_ars,
    cast(sum(approved_amount_ars) as double) / count(approved_amount_ars) as avg_ticket_ars
  from fct_originations group by 1),
j as (select coalesce(a.product_code, o.product_code) as product_code, a.*, o.* exclude (product_code)
      from a full outer join o on a.product_code = o.product_code)
select j.product_code, d.product_name, d.product_type, d.risk_tier,
  cast(coalesce(applications, 0) as bigint) as applications,
  cast(coalesce(approved_applications, 0) as bigint) as approved_applications,
  cast(coalesce(originations, 0) as bigint) as originations,
  cast(requested_amount_ars as double) as requested_amount_ars,
  cast(granted_amount_ars as double) as granted_amount_ars, avg_ticket_ars,
  case when applications > 0 then {O.round_ratio('approved_applications', 'applications', 4)} end as approval_rate,
  case when approved_applications > 0
       then {O.round_ratio('originated_applications', 'approved_applications', 4)} end as take_rate
from j left join dim_products_all d on j.product_code = d.product_code""")

    @register("product_funnel", O.sql_for("select * from product_funnel", ("product_funnel",)))
    def q_product_funnel(spark, sf_dir):
        m = models(spark, sf_dir)
        from loanmart.sources.seeds import SEED_ROWS
        return canonical(product_funnel(m.fct_applications, m.fct_originations, m.dim_products,
                                        SEED_ROWS["products"], m.p.max_broadcast_rows))

    tiers = (" ".join(f"when bureau_score >= {t} then '{lab}'" for t, lab in ENRICHED_SCORE_TIERS))
    O.cte("score_monthly", ("bureau_scd2",), f"""
with m as (select last_day(cast(d as date)) as month_end
      from unnest(generate_series(
        (select cast(date_trunc('month', min(dbt_valid_from)) as date) from bureau_scd2), last_day({O.AS_OF}),
        interval 1 month)) t(d)),
v as (select m.month_end, s.bureau_score from m join bureau_scd2 s
      on s.dbt_valid_from < cast(m.month_end + 1 as timestamp)
     and (s.dbt_valid_to is null or s.dbt_valid_to >= cast(m.month_end + 1 as timestamp)))
select month_end,
  case when bureau_score is null then null {tiers} else '{ENRICHED_SCORE_ELSE}' end as bureau_risk_tier,
  count(*) as customers, avg(bureau_score) as avg_bureau_score,
  cast(min(bureau_score) as bigint) as min_bureau_score, cast(max(bureau_score) as bigint) as max_bureau_score
from v group by 1, 2""")

    @register("score_monthly", O.sql_for("select * from score_monthly", ("score_monthly",)))
    def q_score_monthly(spark, sf_dir):
        return canonical(score_monthly(models(spark, sf_dir).bureau_history))

    run_ts = DEFAULT.run_ts.isoformat(sep=" ")
    fresh_parts = []
    for name, field in (("raw_customers", "updated_at"), ("raw_applications", "application_date")):
        warn, err = FRESHNESS_HOURS[name]
        age = f"floor((epoch(timestamp '{run_ts}') - epoch(max(cast({field} as timestamp)))) / 3600)"
        fresh_parts.append(f"""
select '{name}' as source, max(cast({field} as timestamp)) as max_loaded_at,
  cast({age} as bigint) as age_hours, cast({warn} as bigint) as warn_after_hours,
  cast({err} as bigint) as error_after_hours,
  case when {age} > {err} then 'error' when {age} > {warn} then 'warn' else 'pass' end as status
from {name}""")
    O.cte("freshness", ("raw_customers", "raw_applications"), " union all ".join(fresh_parts))

    @register("freshness", O.sql_for("select * from freshness", ("freshness",)))
    def q_freshness(spark, sf_dir):
        m = models(spark, sf_dir)
        return canonical(freshness({"raw_customers": (m.raw.customers, "updated_at"),
                                    "raw_applications": (m.raw.applications, "application_date")}, m.p))

