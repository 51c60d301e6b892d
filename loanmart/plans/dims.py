"""Dimensions: customers, products and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanmart.functions.calendar import (quarter_end, sunday_week_of_year, week_start_monday,
                                         year_end)
from loanmart.functions.columns import flag, ladder_below, surrogate_key
from loanmart.params import DEFAULT, RunParams
from loanmart.sources import seeds

# --- fixed values (must equal the reference's for equal results) -----------
AGE_GROUPS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_GROUP_ELSE = "55+"
INCOME_TIERS = [(500000, "LOW"), (1500000, "MID"), (3000000, "HIGH")]
INCOME_TIER_ELSE = "PREMIUM"
# Spanish day names, Sunday first (day-of-week number 1..7).
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]
DAY_NAMES_SHORT = ["Dom", "Lun", "Mar", "Mie", "Jue", "Vie", "Sab"]
# Spanish month names, January first.
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
               "Septiembre", "Octubre", "Noviembre", "Diciembre"]
# Default calendar span: [2020-01-01, 2031-01-01).
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2031, 1, 1)
# ---------------------------------------------------------------------------


def dim_customers(customers_enriched: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return customers_enriched.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id", "full_name", "email", "city", "birth_date", "age_years",
        ladder_below("age_years", AGE_GROUPS, AGE_GROUP_ELSE).alias("age_group"),
        "monthly_income_ars", "employment_status", "customer_segment",
        ladder_below("monthly_income_ars", INCOME_TIERS, INCOME_TIER_ELSE).alias("income_tier"),
        "signup_date", "days_since_signup", "account_status",
        "has_bureau_report", "bureau_score", "bureau_risk_tier", "active_debts_count",
        "total_debt_ars", "delinquencies_last_12m", "has_default_history",
        "debt_to_annual_income_ratio",
        F.lit(p.run_ts).cast("timestamp").alias("dbt_updated_at"),
    )


def dim_products(catalog: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return catalog.select(
        "product_code", "product_name", "product_type", "risk_tier",
        "min_amount_ars", "max_amount_ars", "max_term_months",
        flag(F.col("product_type") == "revolving").alias("is_revolving"),
        F.lit(p.run_ts).cast("timestamp").alias("dbt_updated_at"),
    )


def calendar_bounds(spark: SparkSession, start: dt.date = CALENDAR_START,
                    end: dt.date = CALENDAR_END) -> DataFrame:
    """One row (start, end) for a fixed half-open calendar span."""
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def data_calendar_bounds(dates: list[list[Column]], tables: list[DataFrame]) -> DataFrame:
    """One row (start, end) spanning whole years around every date in ``tables``.

    ``dates[i]`` are date columns of ``tables[i]``; each table contributes its
    min/max through one partial aggregate, so only the date columns are scanned.
    """
    def lo(ds):
        return F.min(ds[0]) if len(ds) == 1 else F.least(*[F.min(d) for d in ds])

    def hi(ds):
        return F.max(ds[0]) if len(ds) == 1 else F.greatest(*[F.max(d) for d in ds])

    parts = [t.agg(lo(ds).alias("lo"), hi(ds).alias("hi")) for ds, t in zip(dates, tables)]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    return u.agg(F.trunc(F.min("lo"), "year").alias("start"),
                 F.add_months(F.trunc(F.max("hi"), "year"), 12).alias("end"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day in [start, end) (end exclusive)."""
    return bounds.select(F.explode(F.sequence(F.col("start"), F.date_sub(F.col("end"), 1),
                                              F.expr("interval 1 day"))).alias("date"))


def holidays_dedup(holidays: DataFrame) -> DataFrame:
    """First holiday per date by name (byte order); later entries of the date are dropped."""
    w = Window.partitionBy("date").orderBy("holiday_name")
    return (holidays.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
            .select("date", "holiday_name", "holiday_type", "is_bank_holiday"))


def _lookup(names: list[str], idx: Column) -> Column:
    """names[idx - 1] for a 1-based index column."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def dim_date(bounds: DataFrame, holidays: DataFrame | None = None,
             p: RunParams = DEFAULT) -> DataFrame:
    """Calendar: one row per day of [start, end) with holidays and business-day flags.

    ``holidays`` defaults to the rule-generated holidays of the years spanned.
    """
    spine = date_spine(bounds)
    if holidays is None:
        # Rule-generated: a fixed number of rows per calendar year, so the
        # side is bounded by the calendar span and safe to broadcast.
        h = F.broadcast(holidays_dedup(seeds.holidays_between(bounds, F.col("start"), F.col("end"))))
    else:
        h = holidays_dedup(holidays)
    d = F.col("date")
    joined = spine.join(h, "date", "left").select(
        "date", "holiday_name", "holiday_type",
        F.coalesce(F.col("is_bank_holiday"), F.lit(False)).alias("is_bank_holiday"))
    dow = F.dayofweek(d)
    month_end = F.last_day(d)
    month_start = F.trunc(d, "month")
    q_end = quarter_end(d)
    y_end = year_end(d)
    weekend = dow.isin(1, 7)
    week_start = week_start_monday(d)
    return joined.select(
        "date",
        F.date_format(d, "yyyyMMdd").cast("bigint").alias("date_sk"),
        dow.cast("bigint").alias("day_of_week_number"),
        _lookup(DAY_NAMES, dow).alias("day_name"),
        _lookup(DAY_NAMES_SHORT, dow).alias("day_name_short"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        sunday_week_of_year(d).alias("week_of_year"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        F.month(d).cast("bigint").alias("month_number"),
        _lookup(MONTH_NAMES, F.month(d)).alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        month_start.alias("month_start_date"),
        month_end.alias("month_end_date"),
        F.quarter(d).cast("bigint").alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        q_end.alias("quarter_end_date"),
        F.year(d).cast("bigint").alias("year_number"),
        F.trunc(d, "year").alias("year_start_date"),
        y_end.alias("year_end_date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        flag(weekend).alias("is_weekend"),
        flag(~weekend).alias("is_weekday"),
        flag(F.col("holiday_name").isNotNull()).alias("is_holiday"),
        "holiday_name", "holiday_type", "is_bank_holiday",
        F.when(weekend, F.lit(False)).when(F.col("is_bank_holiday") == F.lit(True), F.lit(False))
        .otherwise(F.lit(True)).alias("is_business_day"),
        flag(d == month_end).alias("is_month_end"),
        flag(d == month_start).alias("is_month_start"),
        flag(d == q_end).alias("is_quarter_end"),
        flag(d == y_end).alias("is_year_end"),
        F.lit(p.run_ts).cast("timestamp").alias("dbt_updated_at"),
    )
