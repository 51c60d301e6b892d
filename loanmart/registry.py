"""Registered queries: key -> (Spark callable, DuckDB oracle SQL).

Every query reads the driver tables of ``sf_dir`` and runs the library's
models over the whole tables. Outputs pass through :func:`canonical`, which
drops the load-time stamps and casts to comparison types (decimals -> double,
small ints -> bigint, timestamps -> timestamp without zone); the oracle SQL
produces the same types.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart import oracle as O
from loanmart.functions.columns import PII_KINDS, mask_pii, surrogate_key
from loanmart.operators import assertions as A
from loanmart.operators import scd2
from loanmart.operators.unique_keys import UniqueKeys
from loanmart.operators.upsert import max_value
from loanmart.params import DEFAULT, RunParams
from loanmart.plans import customer360 as c360
from loanmart.plans import dims, facts, intermediate, metrics, quality, staging
from loanmart.plans.build import build
from loanmart.plans.customer360_incremental import PaymentTotals
from loanmart.plans.models import Models, snapshot_input
from loanmart.session import apply_conf, dealt, materialize, scratch_path
from loanmart.sources import batches
from loanmart.sources.sinks import ROUTES

STAMPS = ("dbt_loaded_at", "dbt_updated_at")


def canonical(df: DataFrame, drop=STAMPS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        t = f.dataType
        c = F.col(f"`{f.name}`")
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_MODEL_CACHE: dict[tuple, Models] = {}


def _models(spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT) -> Models:
    """The model graph for ``sf_dir``, shared by the queries of one session.

    Stateful tables (the bureau history built by the snapshot runs) and tables
    written for multi-reader queries are then built once per session, as they
    would exist in the warehouse, instead of once per query.
    """
    apply_conf(spark)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), params)
    m = _MODEL_CACHE.get(key)
    if m is None:
        if len(_MODEL_CACHE) >= 8:
            _MODEL_CACHE.pop(next(iter(_MODEL_CACHE)))
        m = _MODEL_CACHE[key] = Models(spark, sf_dir, params)
    return m


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle_sql is not None:
            ORACLE[key] = oracle_sql
        return fn
    return deco


def _cast_sql(cte: str, money: tuple = (), ints: tuple = (), where: str = "") -> str:
    """select * with DOUBLE money columns and BIGINT integer columns."""
    rep = [f"cast({c} as double) as {c}" for c in money] + [f"cast({c} as bigint) as {c}" for c in ints]
    star = f"* replace ({', '.join(rep)})" if rep else "*"
    return f"select {star} from {cte}{where}"


def _oracle(cte: str, money=(), ints=(), deps=None, where: str = "") -> str:
    return O.sql_for(_cast_sql(cte, money, ints, where), deps or (cte,))


# --- staging ---------------------------------------------------------------------

@register("stg_customers", _oracle("stg_customers", money=("monthly_income_ars",)))
def q_stg_customers(spark, sf_dir):
    return canonical(_models(spark, sf_dir).stg_customers)


@register("pii_unmasked", _oracle("stg_customers_unmasked", money=("monthly_income_ars",)))
def q_pii_unmasked(spark, sf_dir):
    m = _models(spark, sf_dir, RunParams(mask_pii=False))
    return canonical(m.stg_customers)


@register("pii_mask", O.sql_for("""
select customer_id,
  substring(first_name, 1, 1) || '****' as name_masked,
  substring(email, 1, 2) || '***@masked.com' as email_masked,
  substring(cast(phone as varchar), 1, 4) || '****' || substring(cast(phone as varchar), -2) as phone_masked,
  cast(date_trunc('year', birth_date) as date) as birth_date_masked,
  '*** MASKED ***' as city_masked
from raw_customers""", ("raw_customers",)))
def q_pii_mask(spark, sf_dir):
    """Every masking kind applied to the raw customer PII columns ('other' on city)."""
    raw = _models(spark, sf_dir).raw.customers
    assert set(PII_KINDS) == {"email", "phone", "name", "birth_date"}
    return raw.select(
        "customer_id",
        mask_pii("first_name", "name").alias("name_masked"),
        mask_pii("email", "email").alias("email_masked"),
        mask_pii(F.col("phone").cast("string"), "phone").alias("phone_masked"),
        mask_pii("birth_date", "birth_date").alias("birth_date_masked"),
        mask_pii("city", "other").alias("city_masked"),
    )


@register("customer_sk", O.sql_for("""
select application_id, customer_id,
  md5(coalesce(cast(customer_id as varchar), '_dbt_utils_surrogate_key_null_')) as customer_sk,
  md5(coalesce(cast(customer_id as varchar), '_dbt_utils_surrogate_key_null_') || '-' ||
      coalesce(cast(o.origination_id as varchar), '_dbt_utils_surrogate_key_null_')) as customer_origination_sk
from (select a.application_id, a.customer_id, o.origination_id
      from raw_applications a left join raw_originations o on a.application_id = o.application_id) o""",
                                  ("raw_applications", "raw_originations")))
def q_customer_sk(spark, sf_dir):
    """Surrogate keys per application: on the customer, and on (customer, origination)
    where the origination is often NULL (exercises the NULL placeholder)."""
    m = _models(spark, sf_dir)
    a = m.raw.applications.select("application_id", "customer_id")
    o = m.raw.originations.select("application_id", "origination_id")
    j = a.join(o, "application_id", "left")
    return j.select("application_id", "customer_id",
                    surrogate_key("customer_id").alias("customer_sk"),
                    surrogate_key("customer_id", "origination_id").alias("customer_origination_sk"))


@register("stg_applications", _oracle("stg_applications", money=("requested_amount_ars",)))
def q_stg_applications(spark, sf_dir):
    return canonical(_models(spark, sf_dir).stg_applications)


@register("stg_originations", _oracle("stg_originations", money=("approved_amount_ars", "annual_interest_rate_pct")))
def q_stg_originations(spark, sf_dir):
    return canonical(_models(spark, sf_dir).stg_originations)


@register("stg_payments", _oracle("stg_payments", money=("due_amount_ars", "paid_amount_ars", "payment_variance_ars")))
def q_stg_payments(spark, sf_dir):
    return canonical(_models(spark, sf_dir).stg_payments)


@register("stg_credit_bureau", _oracle("stg_credit_bureau", money=("total_debt_ars",)))
def q_stg_credit_bureau(spark, sf_dir):
    return canonical(_models(spark, sf_dir).stg_credit_bureau)


# --- history ---------------------------------------------------------------------

_BUREAU_MONEY = ("total_debt_ars",)
_BUREAU_INTS = ("bureau_score", "active_debts_count", "delinquencies_last_12m")


@register("bureau_scd2", _oracle("bureau_scd2", money=_BUREAU_MONEY, ints=_BUREAU_INTS))
def q_bureau_scd2(spark, sf_dir):
    return canonical(_models(spark, sf_dir).bureau_history, drop=())


@register("bureau_scd2_deletes", _oracle("bureau_scd2_deletes", money=_BUREAU_MONEY, ints=_BUREAU_INTS))
def q_bureau_scd2_deletes(spark, sf_dir):
    return canonical(scd2.deleted_keys(_models(spark, sf_dir).bureau_history, "customer_id"), drop=())


@register("bureau_current", _oracle("bureau_current", money=_BUREAU_MONEY, ints=_BUREAU_INTS))
def q_bureau_current(spark, sf_dir):
    return canonical(intermediate.bureau_current(_models(spark, sf_dir).bureau_open))


@register("bureau_history_stored", _oracle("bureau_scd2", money=_BUREAU_MONEY, ints=_BUREAU_INTS))
def q_bureau_history_stored(spark, sf_dir):
    """The stored history when it is compacted between runs and after the last one."""
    m = _models(spark, sf_dir)
    root = scratch_path(spark, "bureau_compacted")
    for k, (batch, ts) in enumerate(m.bureau_batches(), start=1):
        scd2.run_snapshot(root, snapshot_input(batch), "customer_id", "report_date", ts)
        if k % 2 == 0:
            scd2.compact(spark, root)
    return canonical(scd2.stored_history(spark, root), drop=())


O.cte("application_reviews", ("raw_applications", "bureau_bounds"), batches.APPLICATION_REVIEWS_SQL)


@register("application_bureau_asof", O.sql_for(_cast_sql("""(
select r.application_id, r.customer_id, r.review_ts, v.bureau_score, v.total_debt_ars, v.active_debts_count,
  v.delinquencies_last_12m, v.has_default_history, v.dbt_valid_from
from application_reviews r left join bureau_scd2 v on v.customer_id = r.customer_id
  and v.dbt_valid_from <= r.review_ts and (v.dbt_valid_to is null or r.review_ts < v.dbt_valid_to))""",
                                                       _BUREAU_MONEY, _BUREAU_INTS), ("application_reviews", "bureau_scd2")))
def q_application_bureau_asof(spark, sf_dir):
    """Every application with the bureau report that held when it was reviewed."""
    m = _models(spark, sf_dir)
    return canonical(metrics.application_bureau(batches.application_reviews(m.raw.applications, m.raw.bureau_feed), m.bureau_history))


# --- intermediate ----------------------------------------------------------------

_ENRICHED_MONEY = ("monthly_income_ars", "total_debt_ars")
_ENRICHED_INTS = _BUREAU_INTS


@register("customers_enriched", _oracle("customers_enriched", money=_ENRICHED_MONEY, ints=_ENRICHED_INTS))
def q_customers_enriched(spark, sf_dir):
    return canonical(_models(spark, sf_dir).customers_enriched)


_OUTCOME_MONEY = ("requested_amount_ars", "approved_amount_ars", "annual_interest_rate_pct")


@register("applications_outcome", _oracle("applications_outcome", money=_OUTCOME_MONEY))
def q_applications_outcome(spark, sf_dir):
    return canonical(_models(spark, sf_dir).applications_outcome)


_PAY_MONEY = ("due_amount_ars", "paid_amount_ars", "payment_variance_ars")


@register("payments_bucketed", _oracle("payments_bucketed", money=_PAY_MONEY, ints=("severity_order",)))
def q_payments_bucketed(spark, sf_dir):
    return canonical(_models(spark, sf_dir).payments_bucketed)


# --- dims --------------------------------------------------------------------------

_DIM_CUST_MONEY = ("monthly_income_ars", "total_debt_ars")


@register("dim_customers", _oracle("dim_customers", money=_DIM_CUST_MONEY, ints=_BUREAU_INTS))
def q_dim_customers(spark, sf_dir):
    return canonical(_models(spark, sf_dir).dim_customers)


@register("dim_products", _oracle("dim_products", money=("min_amount_ars", "max_amount_ars")))
def q_dim_products(spark, sf_dir):
    """Product dimension rows referenced by the applications (semi join)."""
    m = _models(spark, sf_dir)
    used = m.raw.applications.select("product_code").distinct()  # a few codes: combined before the shuffle
    return canonical(m.dim_products.join(used, "product_code", "left_semi"))


@register("date_spine", _oracle("date_spine"))
def q_date_spine(spark, sf_dir):
    """Day spine over the whole years spanned by the loan dates of the tables."""
    return dims.date_spine(_models(spark, sf_dir).calendar_bounds)


@register("holidays_dedup", _oracle("holidays_dedup"))
def q_holidays_dedup(spark, sf_dir):
    from loanmart.sources import seeds
    b = _models(spark, sf_dir).calendar_bounds
    return dims.holidays_dedup(seeds.holidays_between(b, F.col("start"), F.col("end")))


@register("dim_date", _oracle("dim_date"))
def q_dim_date(spark, sf_dir):
    return canonical(_models(spark, sf_dir).dim_date)


@register("dim_date_csv", _oracle("dim_date"))
def q_dim_date_csv(spark, sf_dir):
    """The calendar with its holidays, bands and products read from CSV files (here written
    from the holiday rule and the built-in lists)."""
    return canonical(_from_csv(spark, sf_dir).dim_date)


def _from_csv(spark, sf_dir) -> Models:
    """The model graph with all seeds read from CSV files."""
    from loanmart.sources import seeds
    m = _models(spark, sf_dir)
    folder = scratch_path(spark, "seed_csv")
    rows = {"buckets": m.buckets, "products": m.product_catalog,
            "holidays": seeds.holidays_between(m.calendar_bounds, F.col("start"), F.col("end"))}
    for name, (file, schema) in seeds.SEED_FILES.items():
        rows[name].select(*schema.fieldNames()).write.option("header", True).csv(f"{folder}/{file}.csv")
    fed = Models(spark, sf_dir, seed_dir=folder)
    fed.__dict__["calendar_bounds"] = m.calendar_bounds
    return fed


@register("payments_bucketed_csv", _oracle("payments_bucketed", money=("due_amount_ars", "paid_amount_ars", "payment_variance_ars"), ints=("severity_order",)))
def q_payments_bucketed_csv(spark, sf_dir):
    """Payments classified by bands read from a CSV file."""
    return canonical(_from_csv(spark, sf_dir).payments_bucketed)


@register("dim_products_csv", _oracle("dim_products", money=("min_amount_ars", "max_amount_ars")))
def q_dim_products_csv(spark, sf_dir):
    """Products read from a CSV file, referenced by the applications."""
    m = _from_csv(spark, sf_dir)
    used = m.raw.applications.select("product_code").distinct()
    return canonical(m.dim_products.join(used, "product_code", "left_semi"))


# Holiday lines of a wrong kind: by day and month, a date that is none, a name left out, a
# flag that is none, a comma too many.
@register("seed_rejects", O.sql_for("""
select * from (
  select if(day(date) % 9 = 0, '2024-13-45', cast(date as varchar)) as date, if(month(date) = 8, null, holiday_name) as holiday_name,
    if(month(date) = 7, 'wrong number of columns', concat_ws('; ', if(day(date) % 9 = 0, 'date: not a date', null),
      if(month(date) = 8, 'holiday_name: missing', null), if(month(date) = 5, 'is_bank_holiday: not a boolean', null))) as reason
  from holidays) r""", ("holidays",)))
def q_seed_rejects(spark, sf_dir):
    """Holiday lines of a damaged seed file: rejects with their reason, accepted ones with none ('')."""
    from loanmart.sources import seeds
    b = _models(spark, sf_dir).calendar_bounds
    rows = seeds.holidays_between(b, F.col("start"), F.col("end"))
    day, month = F.dayofmonth("date"), F.month("date")
    damaged = rows.select(
        F.when(day % 9 == 0, "2024-13-45").otherwise(F.col("date").cast("string")).alias("date"),
        F.when(month != 8, F.col("holiday_name")).alias("holiday_name"),
        F.when(month == 7, "one,too many").otherwise(F.col("holiday_type")).alias("holiday_type"),
        F.when(month == 5, "maybe").otherwise(F.col("is_bank_holiday").cast("string")).alias("is_bank_holiday"))
    path = scratch_path(spark, "damaged_seed")
    damaged.write.option("header", True).option("quote", "\u0000").csv(path)  # no quotes: commas divide
    accepted, rejects = seeds.split_seed_csv(spark, path, seeds.HOLIDAY_SCHEMA)
    taken = accepted.select(F.col("date").cast("string").alias("date"), "holiday_name", F.lit("").alias("reason"))
    return rejects.select("date", "holiday_name", "reason").unionByName(taken)


# --- facts ---------------------------------------------------------------------------

_FCT_APP_MONEY = ("requested_amount_ars", "approved_amount_ars")


@register("fct_applications", _oracle("fct_applications", money=_FCT_APP_MONEY))
def q_fct_applications(spark, sf_dir):
    return canonical(_models(spark, sf_dir).fct_applications)


_FCT_ORIG_MONEY = ("approved_amount_ars", "requested_amount_ars", "annual_interest_rate_pct")


@register("fct_originations", _oracle("fct_originations", money=_FCT_ORIG_MONEY))
def q_fct_originations(spark, sf_dir):
    return canonical(_models(spark, sf_dir).fct_originations)


@register("fct_payments", _oracle("fct_payments", money=_PAY_MONEY, ints=("severity_order",)))
def q_fct_payments(spark, sf_dir):
    return canonical(_models(spark, sf_dir).fct_payments)


# --- incremental payment runs -----------------------------------------------------------

RUNS = tuple(range(1, batches.PAYMENT_RUNS + 1))
LOOKBACK_RUNS = (4, 5)  # table loaded at the first, source read at the second
EVOLUTION_RUNS = (4, RUNS[-1])
EVOLUTION_FIRST_COLUMNS = [c for c in facts.FCT_PAYMENT_COLUMNS
                           if c not in ("payment_method", "payment_variance_ars")]


O.cte("payment_bounds", ("raw_payments",), batches.PAYMENT_BOUNDS.replace("{raw_payments}", "raw_payments"))


def _run_ctes(runs, prefix: str) -> None:
    """DuckDB CTEs <prefix>_bk<k>: the bucketed payment view at each run date."""
    for k, run in enumerate(runs, start=1):
        O.cte(f"{prefix}_src{k}", ("raw_payments", "payment_bounds"), batches.payment_source_sql(run))
        O.cte(f"{prefix}_stg{k}", (f"{prefix}_src{k}",), O.stg_payments_sql(f"{prefix}_src{k}"))
        O.cte(f"{prefix}_bk{k}", (f"{prefix}_stg{k}", "buckets"), O.payments_bucketed_sql(f"{prefix}_stg{k}"))


def _merge_chain_sql(prefix: str, n: int, columns_per_run=None) -> str:
    """Union of run slices, latest run wins per payment_id (one CTE per run)."""
    full_cols = facts.FCT_PAYMENT_COLUMNS

    def proj(k):
        cols = columns_per_run[k - 1] if columns_per_run else full_cols
        exprs = []
        for c in full_cols:
            if c == "customer_sk":
                e = "md5(coalesce(cast(customer_id as varchar), '_dbt_utils_surrogate_key_null_'))"
            else:
                e = c
            if c not in cols:
                e = f"null"
            exprs.append(f"{e} as {c}")
        return ", ".join(exprs)

    O.cte(f"{prefix}_t1", (f"{prefix}_bk1",), f"select {proj(1)}, 1 as run from {prefix}_bk1")
    for k in range(2, n + 1):
        O.cte(f"{prefix}_t{k}", (f"{prefix}_t{k - 1}", f"{prefix}_bk{k}"), f"""
select * exclude (rn) from (
  select *, row_number() over (partition by payment_id order by run desc) as rn from (
    select * from {prefix}_t{k - 1}
    union all by name
    select {proj(k)}, {k} as run from {prefix}_bk{k}
    where payment_date >= (select max(payment_date) - 3 from {prefix}_t{k - 1})) u) r
where rn = 1""")
    return f"{prefix}_t{n}"


_run_ctes(RUNS, "inc")
_INC_FINAL = _merge_chain_sql("inc", len(RUNS))

_run_ctes(EVOLUTION_RUNS, "evo")
_EVO_FINAL = _merge_chain_sql("evo", 2, [EVOLUTION_FIRST_COLUMNS, facts.FCT_PAYMENT_COLUMNS])
_run_ctes(LOOKBACK_RUNS, "lb")


@register("payments_upsert", O.sql_for(
    _cast_sql(f"(select * exclude (run) from {_INC_FINAL})", _PAY_MONEY, ("severity_order",)),
    (_INC_FINAL,)))
def q_payments_upsert(spark, sf_dir):
    """Incremental runs (3-day lookback + merge by payment_id) over the payment
    source as seen at each run date, on a table bucketed by key; returns the final
    fact table."""
    m = _models(spark, sf_dir)
    return canonical(facts.incremental_runs_stored(spark, scratch_path(spark, "fct_payments_keyed"), m.payment_feeds(RUNS)))


@register("payments_partitioned", O.sql_for(
    _cast_sql(f"(select * exclude (run), cast(date_trunc('month', payment_date) as date) as payment_month "
              f"from {_INC_FINAL})", _PAY_MONEY, ("severity_order",)),
    (_INC_FINAL,)))
def q_payments_partitioned(spark, sf_dir):
    """Same runs written to a month-partitioned Parquet table (only touched months
    rewritten per run, published together), read back."""
    m = _models(spark, sf_dir)
    path = scratch_path(spark, "fct_payments")
    return canonical(facts.incremental_runs_by_month(spark, path, m.payment_feeds(RUNS)))


_run_ctes(EVOLUTION_RUNS, "bt")
_BT_FINAL = _merge_chain_sql("bt", 2)


BUILD_FEEDS = (3, batches.BUREAU_RUNS)  # bureau feeds of the two builds

# The history that two snapshot runs leave: the same rules over the two feeds they saw.
O.cte("bt_runs", ("bureau_runs",), " union all ".join(f"select {k} as k, run_ts from bureau_runs where k = {run}" for k, run in enumerate(BUILD_FEEDS, start=1)))
O.cte("bt_seen", tuple(f"bureau_b{run}" for run in BUILD_FEEDS), f"""
select *, lag(k) over w as k_before, lag(report_date) over w as date_before
from ({" union all ".join(f"select *, {k} as k from bureau_b{run}" for k, run in enumerate(BUILD_FEEDS, start=1))}) u
window w as (partition by customer_id order by k)""")
for _name in ("starts", "scd2", "current"):
    O.cte(f"bt_{_name}", tuple(d.replace("bureau_", "bt_") for d in O.CTES[f"bureau_{_name}"][1]),
          reduce(lambda sql, n: sql.replace(f"bureau_{n}", f"bt_{n}"), ("seen", "runs", "starts", "scd2"), O.CTES[f"bureau_{_name}"][0]))
O.cte("bt_customers_enriched", ("stg_customers", "bt_current", "score_bands"), O.CTES["customers_enriched"][0].replace("bureau_current", "bt_current"))
O.cte("bt_dim_customers", ("bt_customers_enriched", "age_bands", "income_bands"),
      O.CTES["dim_customers"][0].replace("customers_enriched", "bt_customers_enriched"))


def _built_twice(spark, sf_dir) -> dict[str, str]:
    """Two builds of all models over successive feeds; model -> table or view after the second."""
    m = _models(spark, sf_dir)
    if "built_twice" not in m.__dict__:
        database = f"lm_{scratch_path(spark, 'build')[-12:]}"
        for attr in (database, *(f"{database}_{r}" for r in ROUTES.values())):  # tables live in the shared scratch folder
            spark.sql(f"CREATE DATABASE `{attr}` LOCATION '{scratch_path(spark, attr)}'")
        feeds = m.bureau_batches()
        for run, source in zip(BUILD_FEEDS, m.payment_runs(EVOLUTION_RUNS)):
            m.__dict__["built_twice"] = build(Models(spark, sf_dir, m.p), database, bureau=feeds[run - 1], payments=source)
    return m.__dict__["built_twice"]


@register("build_twice", O.sql_for(
    _cast_sql(f"(select * exclude (run) from {_BT_FINAL})", _PAY_MONEY, ("severity_order",)),
    (_BT_FINAL,)))
def q_build_twice(spark, sf_dir):
    """The payment fact after the second of two builds."""
    return canonical(spark.table(_built_twice(spark, sf_dir)["fct_payments"]).drop(facts.PAYMENT_PARTITION))


@register("build_twice_history", _oracle("bt_scd2", money=_BUREAU_MONEY, ints=_BUREAU_INTS))
def q_build_twice_history(spark, sf_dir):
    """The snapshot's history after the second build, through its view in the snapshots database."""
    return canonical(spark.table(_built_twice(spark, sf_dir)["bureau_history"]), drop=())


@register("build_twice_customers", _oracle("bt_dim_customers", money=_DIM_CUST_MONEY, ints=_BUREAU_INTS))
def q_build_twice_customers(spark, sf_dir):
    """The customer dimension, rebuilt in full, after the second build."""
    return canonical(spark.table(_built_twice(spark, sf_dir)["dim_customers"]))


@register("payments_schema_evolution", O.sql_for(
    _cast_sql(f"(select * exclude (run) from {_EVO_FINAL})", _PAY_MONEY, ("severity_order",)),
    (_EVO_FINAL,)))
def q_payments_schema_evolution(spark, sf_dir):
    """Two runs; the first loads without payment_method / payment_variance_ars,
    the second adds them (appended columns, NULL in rows it does not reload)."""
    m = _models(spark, sf_dir)
    out = facts.incremental_runs_stored(spark, scratch_path(spark, "fct_payments_evolving"), m.payment_feeds(EVOLUTION_RUNS),
                                        columns_per_run=[EVOLUTION_FIRST_COLUMNS, facts.FCT_PAYMENT_COLUMNS])
    return canonical(out.select(*facts.FCT_PAYMENT_COLUMNS))


@register("payments_lookback", O.sql_for(_cast_sql(f"""(
select {O.FCT_PAYMENT_SELECT} from lb_bk2
where payment_date >= (select max(payment_date) - 3 from lb_bk1))""", _PAY_MONEY, ("severity_order",)),
    ("lb_bk1", "lb_bk2")))
def q_payments_lookback(spark, sf_dir):
    """Rows one incremental run loads: source at the later run date, dated within
    3 days of the newest payment of the table loaded at the earlier run date. Only
    the source's months from that day on are read."""
    m = _models(spark, sf_dir)
    (loaded, t_p), (feed, p) = m.payment_feeds(LOOKBACK_RUNS)
    newest = max_value(facts.fct_payments(loaded(None), t_p), "payment_date")
    return canonical(facts.payments_since(feed, newest, False, p))


O.cte("delivery_dates", ("payment_bounds",), " union all ".join(f"select {k} as k, {batches.payment_run_sql(k)} as run_date" for k in RUNS))


def _delivery_ctes(left_out: int = 0) -> str:
    """DuckDB: bucketed delivery k = run-k source rows that appeared or changed in window k;
    the table keeps, per key, the latest delivered version that has a bucket. One delivery may
    be left out."""
    parts, name = [], f"dlv_latest{left_out or ''}"
    for k in RUNS:
        O.cte(f"dlv{k}", (f"inc_bk{k}", "raw_payments", "payment_bounds"),
              f"select *, {k} as k from inc_bk{k} where payment_id in ({batches.payment_changes_sql(k)})")
        if k != left_out:
            parts.append(f"select * from dlv{k}")
    O.cte(name, tuple(f"dlv{k}" for k in range(1, len(RUNS) + 1)), f"""
select * exclude (rn) from (
  select *, row_number() over (partition by payment_id order by k desc) as rn
  from ({' union all '.join(parts)}) u) r
where rn = 1""")
    return name


@register("payments_stream", O.sql_for(_cast_sql(f"""(
select {O.FCT_PAYMENT_SELECT}, cast(date_trunc('month', payment_date) as date) as payment_month
from {_delivery_ctes()})""", _PAY_MONEY, ("severity_order",)), ("dlv_latest",)))
def q_payments_stream(spark, sf_dir):
    """Payment deliveries (one per yearly window) streamed from a landing folder by a
    file-source stream; each micro-batch keeps the latest delivered version per key and
    is merged into the month-partitioned fact. Returns the table after the stream."""
    from loanmart.streaming import payments_stream as ps
    m = _models(spark, sf_dir)
    landing = scratch_path(spark, "landing_payments")
    target = scratch_path(spark, "fct_payments_stream")
    ps.write_deliveries(spark, m.payment_source_table, m.payment_run_dates, landing)
    q = ps.start_payment_load(spark, ps.payment_stream(spark, landing, ps.files_per_batch(spark, landing)), target,
                              scratch_path(spark, "stream_checkpoint"), m.buckets, m.p)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return canonical(spark.read.option("mergeSchema", "true").parquet(target).drop(ps.VERSION))


#: The order in which deliveries land: one is repeated, one comes a window late, one much too late.
LANDING_ORDER = (1, 3, 3, 4, 6, 5, 2, 7, 8)
TOO_LATE = 2

_loaded = _delivery_ctes(TOO_LATE)


@register("payments_event_time", O.sql_for(f"""
select 'loaded' as kind, payment_id, payment_date, cast(paid_amount_ars as double) as paid_amount_ars, cast(d.run_date - 1 as date) as delivered_at
from {_loaded} l join delivery_dates d using (k)
union all
select 'late', payment_id, payment_date, cast(paid_amount_ars as double), cast(d.run_date - 1 as date)
from inc_src{TOO_LATE} s join delivery_dates d on d.k = {TOO_LATE}
where payment_id in ({batches.payment_changes_sql(TOO_LATE)})""", (_loaded, f"inc_src{TOO_LATE}", "delivery_dates", "raw_payments", "payment_bounds")))
def q_payments_event_time(spark, sf_dir):
    """Payment deliveries that land out of order: the fact without repeats, and the rows that
    came later than the watermark allows (one and a half windows)."""
    from loanmart.streaming import event_time as et
    from loanmart.streaming import payments_stream as ps
    m = _models(spark, sf_dir)
    dates = m.payment_run_dates
    landing, target, taken, progress = (scratch_path(spark, f"event_time_{x}") for x in ("landing", "fact", "taken", "progress"))
    delay = f"{max(1, (dates[-1] - dates[0]).days * 3 // (2 * max(1, len(dates) - 1)))} days"
    repeated = materialize(batches.repeated_payments(m.payment_source_table), "repeated_payments")
    for k in LANDING_ORDER:
        ps.write_delivery(spark, m.payment_source_table, dates, k - 1, landing, repeated)
        et.run_load(spark, landing, target, taken, progress, delay, m.buckets, m.p)
    columns = ["payment_id", "payment_date", "paid_amount_ars", ps.VERSION]
    loaded = spark.read.parquet(target).select(F.lit("loaded").alias("kind"), *columns)
    late = et.late_rows(spark, landing, taken).select(F.lit("late").alias("kind"), *columns)
    return canonical(loaded).unionByName(canonical(late))


# --- customer 360 ------------------------------------------------------------------------

@register("apps_summary", _oracle("apps_summary", ints=("approved_applications", "rejected_applications",
                                                           "pending_applications")))
def q_apps_summary(spark, sf_dir):
    return canonical(c360.apps_summary(_models(spark, sf_dir).fct_applications))


@register("originations_summary", _oracle("originations_summary", money=("total_credit_granted_ars",)))
def q_originations_summary(spark, sf_dir):
    return canonical(c360.originations_summary(_models(spark, sf_dir).fct_originations))


@register("payments_summary", _oracle("payments_summary", ints=("on_time_payments", "delinquent_payments",
                                                                   "max_days_past_due", "worst_bucket_ever")))
def q_payments_summary(spark, sf_dir):
    return canonical(c360.payments_summary(_models(spark, sf_dir).fct_payments))


_C360_INTS = ("total_applications", "approved_applications", "rejected_applications",
              "total_originations", "total_payments", "on_time_payments", "delinquent_payments",
              "max_days_past_due", "bureau_score")


@register("customer_360", _oracle("customer_360", money=("monthly_income_ars", "total_credit_granted_ars"),
                                  ints=_C360_INTS))
def q_customer_360(spark, sf_dir):
    return canonical(_models(spark, sf_dir).customer_360)


O.cte("customer_events_loaded", ("fct_applications", "fct_originations", _INC_FINAL),
      O.CTES["customer_events"][0].replace("from fct_payments", f"from {_INC_FINAL}"))
O.cte("customer_360_loaded", ("dim_customers", "customer_events_loaded", "risk_bands"),
      O.CTES["customer_360"][0].replace("customer_events", "customer_events_loaded"))


@register("customer_360_incremental", _oracle("customer_360_loaded", money=("monthly_income_ars", "total_credit_granted_ars"), ints=_C360_INTS))
def q_customer_360_incremental(spark, sf_dir):
    """The customer 360 after all payment runs, its payment totals kept up to date by each
    run's changes."""
    m = _models(spark, sf_dir)
    kept = PaymentTotals(spark, scratch_path(spark, "payment_totals"))
    for feed, p in m.payment_feeds(RUNS):
        first = not kept.facts.exists()
        newest = None if first else kept.facts.max_value("payment_date")
        kept.load(facts.payments_since(feed, newest, first, p))
    return canonical(c360.from_summaries(m.dim_customers, c360.apps_summary(m.fct_applications), c360.originations_summary(m.fct_originations),
                                         kept.summary(), m.p))


# --- data quality ---------------------------------------------------------------------------

_SUITE_TABLES = ["raw_customers", "raw_applications", "raw_originations", "raw_payments",
                 "raw_credit_bureau", "dim_customers", "dim_products", "dim_date", "fct_applications",
                 "fct_originations", "fct_payments", "customer_360"]


def _quality_tables(m: Models, checks) -> dict[str, DataFrame]:
    """Tables the checks read; those read by more than one part of the report are
    written once before, and their row checks are gathered meanwhile."""
    reads = Counter()
    for table, parts in quality.parts_by_table(checks).items():
        reads[table] += len(parts)
    quality.write_observed(m, [t for t in _SUITE_TABLES if reads[t] > 1])
    get = {
        "raw_customers": lambda: m.raw.customers, "raw_applications": lambda: m.raw.applications,
        "raw_originations": lambda: m.raw.originations, "raw_payments": lambda: m.raw.payments,
        "raw_credit_bureau": lambda: m.raw_credit_bureau, "lineitem": lambda: m.raw.get("lineitem"),
        "applications_text_keys": lambda: quality.text_keys(m.raw.applications),
        "dim_customers": lambda: m.dim_customers, "dim_products": lambda: m.dim_products, "dim_date": lambda: m.dim_date,
        "fct_applications": lambda: m.fct_applications, "fct_originations": lambda: m.fct_originations,
        "fct_payments": lambda: m.fct_payments, "customer_360": lambda: m.customer_360,
    }
    return {t: get[t]() for t in reads}


O.cte("applications_text_keys", ("raw_applications",), quality.TEXT_KEYS_SQL)
_DQ_DEPS = ("raw_customers", "raw_applications", "raw_originations", "raw_payments", "raw_credit_bureau",
            "dim_customers", "dim_products", "dim_date", "fct_applications", "fct_originations",
            "fct_payments", "customer_360", "applications_text_keys")


def _dq_union_sql(checks) -> str:
    return "\nunion all\n".join(quality.check_sql(*c) for c in checks)


def _dq_oracle(checks) -> str:
    tables = {c[0] for c in checks} | {c[3][0] for c in checks if c[1] == "relationships"}
    deps = tuple(t for t in _DQ_DEPS if t in tables)
    return O.sql_for(_dq_union_sql(checks), deps)


def _failures(m: Models, checks) -> DataFrame:
    suite = quality.build_suite(_quality_tables(m, checks), checks)
    return A.failure_report(suite, {name: n for of_table in m.observed.values() for name, n in of_table.items()})


def _dq(spark, sf_dir, kind):
    return _failures(_models(spark, sf_dir), quality.checks_of_kind(kind))


@register("dq_unique", _dq_oracle(quality.checks_of_kind("unique")))
def q_dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, "unique")


@register("dq_not_null", _dq_oracle(quality.checks_of_kind("not_null")))
def q_dq_not_null(spark, sf_dir):
    return _dq(spark, sf_dir, "not_null")


@register("dq_accepted_values", _dq_oracle(quality.checks_of_kind("accepted_values")))
def q_dq_accepted_values(spark, sf_dir):
    return _dq(spark, sf_dir, "accepted_values")


@register("dq_relationships", _dq_oracle(quality.checks_of_kind("relationships")))
def q_dq_relationships(spark, sf_dir):
    return _dq(spark, sf_dir, "relationships")


# Rows behind the failing fixture assertions.

@register("dq_rows_unique", O.sql_for("""
select l_orderkey, l_linenumber, count(*) as n_records from lineitem
group by all having count(*) > 1""", ()))
def q_dq_rows_unique(spark, sf_dir):
    return canonical(A.unique_combination_violations(_models(spark, sf_dir).raw.get("lineitem"), ("l_orderkey", "l_linenumber")))


#: Batches of line items, by ship date, that the repeated keys are looked for in.
LINE_BATCHES = 6


@register("dq_rows_unique_incremental", O.sql_for("""
select l_orderkey, l_linenumber, count(*) as n_records from lineitem
group by all having count(*) > 1""", ()))
def q_dq_rows_unique_incremental(spark, sf_dir):
    """The repeated line keys, found batch by batch as line items arrive by ship date; each
    batch is compared with the fingerprints of those before it."""
    apply_conf(spark)
    columns = ["l_orderkey", "l_linenumber"]
    lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*columns, F.to_date("l_shipdate").alias("day"))
    lo, hi = lines.agg(F.min("day"), F.max("day")).first()
    borders = [] if lo is None else [lo + (hi - lo) * k / LINE_BATCHES for k in range(1, LINE_BATCHES)]
    edges = [None, *borders, None]

    def batch(k):  # rows without a date come first
        low, high = edges[k], edges[k + 1]
        rows = lines if high is None else lines.where((F.col("day") < F.lit(high)) | F.col("day").isNull())
        return rows if low is None else rows.where(F.col("day") >= F.lit(low))

    check = UniqueKeys(spark, scratch_path(spark, "line_keys"), columns)
    older = lambda names: reduce(DataFrame.unionByName, [batch(int(n)) for n in names])
    found = [check.check(batch(k), str(k), older) for k in range(len(edges) - 1)]
    # a key may be reported by several batches: the last one counts all of its rows
    repeated = reduce(DataFrame.unionByName, found)
    return canonical(dealt(repeated, repeated.count(), *columns).groupBy(*columns).agg(F.max("n_records").alias("n_records")))


@register("dq_rows_not_null", O.sql_for("""
select payment_id, origination_id, cast(installment_number as bigint) as installment_number
from raw_payments where payment_date is null""", ("raw_payments",)))
def q_dq_rows_not_null(spark, sf_dir):
    bad = A.not_null_violations(_models(spark, sf_dir).raw.payments, "payment_date")
    return canonical(bad.select("payment_id", "origination_id", "installment_number"))


@register("dq_rows_accepted_values", O.sql_for("""
select product_code as value_field, count(*) as n_records from raw_applications
group by 1 having product_code not in ('CREDIT_CARD', 'PERSONAL_LOAN')""", ("raw_applications",)))
def q_dq_rows_accepted_values(spark, sf_dir):
    return canonical(A.accepted_values_violations(_models(spark, sf_dir).raw.applications, "product_code", ["CREDIT_CARD", "PERSONAL_LOAN"]))


@register("dq_rows_relationships", O.sql_for("""
select application_id, customer_key from applications_text_keys
where try_cast(customer_key as bigint) is null
   or try_cast(customer_key as bigint) not in (select customer_id from raw_customers)""",
                                            ("applications_text_keys", "raw_customers")))
def q_dq_rows_relationships(spark, sf_dir):
    m = _models(spark, sf_dir)
    return canonical(A.relationship_violations(quality.text_keys(m.raw.applications), "customer_key", m.raw.customers, "customer_id"))


O.cte("raw_originations_raised", ("raw_originations",), f"""
select * replace (cast(case when origination_id % {quality.RAISED_SLICE_MOD} = 0
                           then approved_amount_ars * 2 else approved_amount_ars end as decimal(18,2))
                  as approved_amount_ars)
from raw_originations""")
O.cte("stg_originations_raised", ("raw_originations_raised",),
      O.CTES["stg_originations"][0].replace("from raw_originations", "from raw_originations_raised"))
O.cte("fct_originations_raised", ("stg_originations_raised", "stg_applications"),
      O.CTES["fct_originations"][0].replace("from stg_originations o", "from stg_originations_raised o"))

_AMOUNT_MONEY = ("requested_amount_ars", "approved_amount_ars", "excess_amount_ars")


@register("dq_amount_rule", O.sql_for(
    _cast_sql("(" + quality.amount_rule_sql("fct_originations_raised", "fct_applications") + ")",
              _AMOUNT_MONEY),
    ("fct_originations_raised", "fct_applications")))
def q_dq_amount_rule(spark, sf_dir):
    """Rule rows (approved > requested) over originations with a doubled slice."""
    m = _models(spark, sf_dir)
    raised = staging.stg_originations(quality.raised_originations(m.raw.originations))
    fo = facts.fct_originations(raised, m.stg_applications)
    return canonical(quality.amount_rule_violations(fo, m.fct_applications))


@register("dq_report", O.sql_for(
    _dq_union_sql(quality.all_checks()) + "\nunion all\n" + " union all ".join([
        f"select '{quality.AMOUNT_RULE}' as assertion, cast(count(*) as bigint) as failures from ("
        + quality.amount_rule_sql("fct_originations", "fct_applications") + ") r",
        f"select '{quality.AMOUNT_RULE_FIXTURE}' as assertion, cast(count(*) as bigint) as failures from ("
        + quality.amount_rule_sql("fct_originations_raised", "fct_applications") + ") r",
    ]),
    _DQ_DEPS + ("fct_originations_raised",)))
def q_dq_report(spark, sf_dir):
    """Every declared assertion plus the fixture ones: (assertion, failures)."""
    m = _models(spark, sf_dir)
    report = _failures(m, quality.all_checks())
    raised = staging.stg_originations(quality.raised_originations(m.raw.originations))
    fo_raised = facts.fct_originations(raised, m.stg_applications)
    rules = [quality.rule_count(quality.AMOUNT_RULE,
                                quality.amount_rule_violations(m.fct_originations, m.fct_applications)),
             quality.rule_count(quality.AMOUNT_RULE_FIXTURE,
                                quality.amount_rule_violations(fo_raised, m.fct_applications))]
    return reduce(DataFrame.unionByName, [report] + rules)


# --- portfolio measures -----------------------------------------------------------------------

metrics.register_all(register, _models, canonical)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
