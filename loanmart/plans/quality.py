"""The declared data-quality suite over raw sources and marts.

The suite is data: one tuple per assertion, so the same declaration drives
the Spark evaluation (:func:`build_suite`) and the SQL oracle.

Besides the declared assertions, a few *fixture* assertions run on inputs
with known violations (a non-unique line key, nullable columns, a value list
with one code left out, a foreign key against a filtered parent, and an
amount rule over originations whose approved amount is doubled on a slice),
so that a broken check cannot hide behind an all-zero report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.operators import assertions as A
from loanmart.session import materialize

# --- fixed values (must equal the reference's for equal results) -----------
SEGMENTS = ["A", "B", "C", "D"]
ACCOUNT_STATUSES = ["active", "blocked", "churned"]
APPLICATION_STATUSES = ["approved", "rejected", "pending"]
AGE_GROUP_VALUES = ["18-24", "25-34", "35-44", "45-54", "55+"]
INCOME_TIER_VALUES = ["LOW", "MID", "HIGH", "PREMIUM"]
PRODUCT_RISK_TIERS = ["low", "medium", "high"]
BUCKET_CODES = ["CURRENT", "B1_29", "B30_59", "B60_89", "B90_PLUS", "DEFAULT"]
RISK_STATUSES = ["CURRENT", "LOW_RISK", "MEDIUM_RISK", "HIGH_RISK", "DEFAULT", "NO_HISTORY"]
# ---------------------------------------------------------------------------

# (table, kind, column(s), argument)
#   unique / not_null: argument None
#   accepted_values: list of values
#   relationships: (parent table, parent column, parent filter SQL or None)
SOURCE_CHECKS = [
    ("raw_customers", "unique", "customer_id", None),
    ("raw_customers", "not_null", "customer_id", None),
    ("raw_customers", "accepted_values", "customer_segment", SEGMENTS),
    ("raw_customers", "accepted_values", "account_status", ACCOUNT_STATUSES),
    ("raw_applications", "unique", "application_id", None),
    ("raw_applications", "not_null", "application_id", None),
    ("raw_applications", "not_null", "customer_id", None),
    ("raw_applications", "relationships", "customer_id", ("raw_customers", "customer_id", None)),
    ("raw_applications", "accepted_values", "application_status", APPLICATION_STATUSES),
    ("raw_originations", "unique", "origination_id", None),
    ("raw_originations", "not_null", "origination_id", None),
    ("raw_originations", "not_null", "application_id", None),
    ("raw_originations", "relationships", "application_id", ("raw_applications", "application_id", None)),
    ("raw_originations", "not_null", "customer_id", None),
    ("raw_originations", "relationships", "customer_id", ("raw_customers", "customer_id", None)),
    ("raw_payments", "unique", "payment_id", None),
    ("raw_payments", "not_null", "payment_id", None),
    ("raw_payments", "not_null", "origination_id", None),
    ("raw_payments", "relationships", "origination_id", ("raw_originations", "origination_id", None)),
    ("raw_payments", "not_null", "customer_id", None),
    ("raw_payments", "relationships", "customer_id", ("raw_customers", "customer_id", None)),
    ("raw_credit_bureau", "unique", "customer_id", None),
    ("raw_credit_bureau", "not_null", "customer_id", None),
    ("raw_credit_bureau", "relationships", "customer_id", ("raw_customers", "customer_id", None)),
]

MART_CHECKS = [
    ("dim_customers", "unique", "customer_sk", None),
    ("dim_customers", "not_null", "customer_sk", None),
    ("dim_customers", "unique", "customer_id", None),
    ("dim_customers", "not_null", "customer_id", None),
    ("dim_customers", "accepted_values", "age_group", AGE_GROUP_VALUES),
    ("dim_customers", "accepted_values", "income_tier", INCOME_TIER_VALUES),
    ("dim_customers", "not_null", "customer_segment", None),
    ("dim_products", "unique", "product_code", None),
    ("dim_products", "not_null", "product_code", None),
    ("dim_products", "accepted_values", "risk_tier", PRODUCT_RISK_TIERS),
    ("dim_date", "unique", "date", None),
    ("dim_date", "not_null", "date", None),
    ("dim_date", "unique", "date_sk", None),
    ("dim_date", "not_null", "date_sk", None),
    ("dim_date", "not_null", "is_business_day", None),
    ("dim_date", "not_null", "is_holiday", None),
    ("fct_applications", "unique", "application_id", None),
    ("fct_applications", "not_null", "application_id", None),
    ("fct_applications", "not_null", "customer_id", None),
    ("fct_applications", "relationships", "customer_id", ("dim_customers", "customer_id", None)),
    ("fct_applications", "not_null", "product_code", None),
    ("fct_applications", "relationships", "product_code", ("dim_products", "product_code", None)),
    ("fct_applications", "accepted_values", "application_status", APPLICATION_STATUSES),
    ("fct_originations", "unique", "origination_id", None),
    ("fct_originations", "not_null", "origination_id", None),
    ("fct_originations", "not_null", "customer_id", None),
    ("fct_originations", "relationships", "customer_id", ("dim_customers", "customer_id", None)),
    ("fct_originations", "not_null", "product_code", None),
    ("fct_originations", "relationships", "product_code", ("dim_products", "product_code", None)),
    ("fct_payments", "not_null", "customer_sk", None),
    ("fct_payments", "relationships", "customer_sk", ("dim_customers", "customer_sk", None)),
    ("fct_payments", "unique", "payment_id", None),
    ("fct_payments", "not_null", "payment_id", None),
    ("fct_payments", "not_null", "origination_id", None),
    ("fct_payments", "relationships", "origination_id", ("fct_originations", "origination_id", None)),
    ("fct_payments", "not_null", "customer_id", None),
    ("fct_payments", "relationships", "customer_id", ("dim_customers", "customer_id", None)),
    ("fct_payments", "accepted_values", "bucket_code", BUCKET_CODES),
    ("customer_360", "unique", "customer_id", None),
    ("customer_360", "not_null", "customer_id", None),
    ("customer_360", "relationships", "customer_id", ("dim_customers", "customer_id", None)),
    ("customer_360", "accepted_values", "current_risk_status", RISK_STATUSES),
]

# Fixture assertions with known violations.
FIXTURE_CHECKS = [
    ("lineitem", "unique_combination", ("l_orderkey", "l_linenumber"), None),
    ("raw_customers", "not_null", "monthly_income_ars", None),
    ("raw_payments", "not_null", "payment_date", None),
    ("raw_applications", "accepted_values", "product_code", ["CREDIT_CARD", "PERSONAL_LOAN"]),
    ("raw_payments", "relationships", "customer_id",
     ("raw_customers", "customer_id", "account_status = 'active'")),
    ("applications_text_keys", "relationships", "customer_key", ("raw_customers", "customer_id", None)),
]

# Fixture input with keys as text, malformed on a slice of applications.
MALFORMED_MOD = 13
TEXT_KEYS_SQL = f"""
select application_id,
  case when application_id % {MALFORMED_MOD} = 0 then 'no-key' else cast(customer_id as varchar) end as customer_key
from raw_applications"""

# Singular business rule: approved amount never exceeds the requested amount.
AMOUNT_RULE = "approved_amount_never_exceeds_requested"
AMOUNT_RULE_FIXTURE = "approved_amount_never_exceeds_requested__raised_slice"
# Originations whose approved amount is doubled on this slice.
RAISED_SLICE_MOD = 9


def check_name(table: str, kind: str, cols, arg) -> str:
    c = "_".join(cols) if isinstance(cols, tuple) else cols
    if kind == "relationships":
        parent, field, flt = arg
        suffix = f"__{parent}_{field}" + ("__filtered" if flt else "")
        return f"relationships_{table}_{c}{suffix}"
    if kind == "accepted_values" and (table, kind, cols, arg) in FIXTURE_CHECKS:
        return f"accepted_values_{table}_{c}__subset"
    return f"{kind}_{table}_{c}"


def all_checks():
    return SOURCE_CHECKS + MART_CHECKS + FIXTURE_CHECKS


def checks_of_kind(kind: str):
    return [c for c in all_checks() if c[1] == kind or (kind == "unique" and c[1] == "unique_combination")]


def parts_by_table(checks) -> dict[str, set]:
    """The parts of the failure report that read each table (see ``failure_report``)."""
    parts: dict[str, set] = {}
    for table, kind, cols, arg in checks:
        part = {"not_null": "scan", "rule": "scan", "unique_combination": "unique"}.get(kind, kind)
        parts.setdefault(table, set()).add((part, cols) if kind == "relationships" else part)
        if kind == "relationships":
            parts.setdefault(arg[0], set()).add(("parent", arg[1], arg[2]))
    return parts


def raised_originations(raw_originations: DataFrame) -> DataFrame:
    """Fixture input: approved amount doubled on a slice of originations."""
    amt = F.col("approved_amount_ars")
    return raw_originations.withColumn(
        "approved_amount_ars",
        F.when(F.col("origination_id") % RAISED_SLICE_MOD == 0, amt * F.lit(2)).otherwise(amt)
        .cast("decimal(18,2)"))


def text_keys(raw_applications: DataFrame) -> DataFrame:
    """Fixture input: see TEXT_KEYS_SQL."""
    key = F.when(F.col("application_id") % MALFORMED_MOD == 0, "no-key").otherwise(F.col("customer_id").cast("string"))
    return raw_applications.select("application_id", key.alias("customer_key"))


def amount_rule_violations(fct_originations: DataFrame, fct_applications: DataFrame) -> DataFrame:
    """Originations approved above the requested amount (inner join on application_id)."""
    o = fct_originations.alias("o")
    a = fct_applications.alias("a")
    return (o.join(a, F.col("o.application_id") == F.col("a.application_id"), "inner")
            .where(F.col("o.approved_amount_ars") > F.col("a.requested_amount_ars"))
            .select("o.origination_id", "o.application_id", "o.customer_id",
                    "a.requested_amount_ars", "o.approved_amount_ars",
                    (F.col("o.approved_amount_ars") - F.col("a.requested_amount_ars")).alias("excess_amount_ars")))


def build_suite(tables: dict[str, DataFrame], checks) -> A.Suite:
    suite = A.Suite()
    for table, kind, cols, arg in checks:
        name = check_name(table, kind, cols, arg)
        t = suite.table(table, tables[table])
        if kind == "unique":
            t.unique(cols, name)
        elif kind == "unique_combination":
            t.unique_combination(list(cols), name)
        elif kind == "not_null":
            t.not_null(cols, name)
        elif kind == "accepted_values":
            t.accepted_values(cols, arg, name)
        elif kind == "relationships":
            parent, field, flt = arg
            pdf = tables[parent]
            if flt:
                pdf = pdf.where(F.expr(flt))
            t.relationships(cols, pdf, field, parent, name)
        else:
            raise ValueError(kind)
    return suite


def write_observed(m, names: list[str]) -> None:
    """Write tables of the model graph once, and note in ``m.observed`` the failures of their
    not-null, accepted-values and rule checks, gathered in the same pass."""
    def write(name: str, df: DataFrame) -> DataFrame:
        own = [c for c in all_checks() if c[0] == name and c[1] in ("not_null", "accepted_values")]
        checks = build_suite({name: df}, own).tables[name].checks if own else []
        out, m.observed[name] = A.observed_write(df, checks, lambda d: materialize(d, name))
        return out

    m.write_tables(names, write)


def rule_count(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(name).alias("assertion"), "failures")


# --- SQL oracle form (one test query per assertion, counted) ----------------

def check_sql(table: str, kind: str, cols, arg) -> str:
    name = check_name(table, kind, cols, arg)
    if kind == "unique":
        q = f"select {cols} from {table} where {cols} is not null group by {cols} having count(*) > 1"
    elif kind == "unique_combination":
        cl = ", ".join(cols)
        q = f"select {cl} from {table} group by {cl} having count(*) > 1"
    elif kind == "not_null":
        q = f"select {cols} from {table} where {cols} is null"
    elif kind == "accepted_values":
        vals = ", ".join("'" + v + "'" for v in arg)
        q = (f"select v from (select {cols} as v, count(*) as n from {table} group by {cols}) t "
             f"where v not in ({vals})")
    elif kind == "relationships":
        parent, field, flt = arg
        where = f" where {flt}" if flt else ""
        q = (f"select {cols} from {table} where {cols} is not null and cast({cols} as varchar) not in "
             f"(select cast({field} as varchar) from {parent}{where}{' and' if flt else ' where'} {field} is not null)")
    else:
        raise ValueError(kind)
    return f"select '{name}' as assertion, cast(count(*) as bigint) as failures from ({q}) q"


# The rule as declared facts: no row of the first table has a value above its partner's limit.
AMOUNT_RULE_DECLARED = {"value": "approved_amount_ars", "limit": "requested_amount_ars", "key": "application_id",
                        "shown": ("origination_id", "application_id", "customer_id")}


def amount_rule_sql(checked: str, limits: str) -> str:
    """Violating rows of the declared rule between two tables."""
    r = AMOUNT_RULE_DECLARED
    return f"""
with limits as (select {r["key"]} as k, max({r["limit"]}) as top from {limits} group by 1)
select {", ".join(r["shown"])}, top as {r["limit"]}, {r["value"]}, {r["value"]} - top as excess_amount_ars
from {checked}, limits where k = {r["key"]} and {r["value"]} - top > 0"""
