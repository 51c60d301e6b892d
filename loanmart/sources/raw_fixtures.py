"""Raw loan-system tables derived from the driver's TPC-H-like tables.

The loan models read five raw tables (customers, applications, originations,
payments, credit-bureau reports). No raw data ships with the reference, so the
test tables are reshaped into those schemas here. These statements only give
rows the shape the models expect; all model logic lives in ``loanmart.plans``.

Each statement is kept as SQL text with ``{name}`` placeholders so the very
same text runs in Spark (placeholders bound to DataFrames through
``spark.sql(text, name=df)``) and in the DuckDB oracle (placeholders bound to
view names). Equal fixture rows in both engines are a precondition of the
oracle comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns read from each driver table (keeps parquet scans pruned).
DRIVER_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_returnflag"],
    "events": ["event_id", "ts", "user_id", "event_type", "value"],
}

RAW_CUSTOMERS = """
select c_custkey as customer_id, 'Customer' as first_name, substring(c_name,10) as last_name,
  concat('c',cast(c_custkey as string),'@example.com') as email, 5400000000+c_custkey*7919 as phone,
  concat('CITY_',cast(c_nationkey as string)) as city,
  date '1950-01-01'+cast((c_custkey*37)%20000 as int) as birth_date,
  case when c_custkey%50=0 then null else (cast(c_acctbal as decimal(18,2))+1000)*300 end as monthly_income_ars,
  c_mktsegment as employment_status,
  case c_custkey%4 when 0 then 'A' when 1 then 'B' when 2 then 'C' else 'D' end as customer_segment,
  date '1994-01-01'+cast(c_custkey%365 as int) as signup_date,
  case c_custkey%10 when 0 then 'blocked' when 1 then 'churned' else 'active' end as account_status,
  cast(date '2024-01-01'+cast(c_custkey%30 as int) as timestamp) as updated_at
from {customer}
"""

RAW_APPLICATIONS = """
select o_orderkey as application_id, o_custkey as customer_id,
  case o_orderkey%3 when 0 then 'CREDIT_CARD' when 1 then 'PERSONAL_LOAN' else 'CREDIT_LINE' end as product_code,
  cast(o_totalprice as decimal(18,2)) as requested_amount_ars,
  case when o_orderpriority='1-URGENT' then 'branch' when o_orderpriority='2-HIGH' then 'web' else 'app' end as channel,
  case o_orderstatus when 'F' then 'approved' when 'O' then 'rejected' else 'pending' end as application_status,
  cast(o_orderdate as date) as application_date,
  case when o_orderstatus='P' then null else cast(o_orderdate as date)+cast(o_orderkey%15 as int) end as decision_date
from {orders}
"""

RAW_ORIGINATIONS = """
select application_id+10000000 as origination_id, application_id, customer_id, product_code,
  round(requested_amount_ars*cast(60+application_id%41 as decimal(5,0))*cast(0.01 as decimal(3,2)),2) as approved_amount_ars,
  case when application_id%7=0 then 0 else 12*(application_id%5) end as term_months,
  cast(30+application_id%60 as decimal(9,2))+cast(0.5 as decimal(2,1)) as annual_interest_rate_pct,
  decision_date+cast(application_id%4 as int) as origination_date,
  decision_date+cast(application_id%4+30 as int) as first_payment_due_date
from {raw_applications} where application_status='approved' and application_id%5<>0
"""

RAW_PAYMENTS = """
select payment_id, origination_id, customer_id, installment_number, due_date,
  case when k%97=0 then null else due_date+cast(case when k%10<5 then 0 when k%10=5 then -1-k%9
    when k%10=6 then 1+k%29 when k%10=7 then 30+k%30 when k%10=8 then 60+k%120 else 150+k%100 end as int) end as payment_date,
  due_amount_ars,
  case when k%13=0 then due_amount_ars-cast(10.25 as decimal(4,2)) else due_amount_ars end as paid_amount_ars,
  payment_method
from (select concat(cast(l_orderkey as string),'-',cast(l_linenumber as string),'-',cast(l_partkey as string),'-',
        cast(l_suppkey as string),'-',cast(cast(l_quantity as int) as string)) as payment_id,
      o.origination_id, o.customer_id, l_linenumber as installment_number,
      o.origination_date+cast(30*l_linenumber as int) as due_date,
      cast(l_extendedprice as decimal(18,2)) as due_amount_ars,
      case l_returnflag when 'A' then 'debit' when 'R' then 'transfer' else 'cash' end as payment_method, l_partkey as k
    from {lineitem} join {raw_originations} o on l_orderkey=o.application_id) x
"""

# One credit-bureau report per event; a daily feed keeps the latest report per
# customer (see ``loanmart.sources.batches.bureau_batch``).
BUREAU_FEED = """
select user_id as customer_id, 300+event_id%651 as bureau_score, cast(value as decimal(18,2))*10000 as total_debt_ars,
  event_id%6 as active_debts_count, event_id%4 as delinquencies_last_12m,
  event_type='error' as has_default_history, ts as report_ts, event_id
from {events}
"""

# name -> (sql template, inputs it binds)
RAW_SQL = {
    "raw_customers": (RAW_CUSTOMERS, ("customer",)),
    "raw_applications": (RAW_APPLICATIONS, ("orders",)),
    "raw_originations": (RAW_ORIGINATIONS, ("raw_applications",)),
    "raw_payments": (RAW_PAYMENTS, ("lineitem", "raw_originations")),
    "bureau_feed": (BUREAU_FEED, ("events",)),
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver parquet table, reading only the columns the fixtures use."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*DRIVER_COLUMNS[name])


class RawTables:
    """Lazily built raw tables for one scale-factor directory.

    Every property is a lazy DataFrame; nothing runs until an action.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _driver(self, name: str) -> DataFrame:
        return read_driver_table(self.spark, self.sf_dir, name)

    def get(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in DRIVER_COLUMNS:
            df = self._driver(name)
        else:
            sql, inputs = RAW_SQL[name]
            df = self.spark.sql(sql, **{i: self.get(i) for i in inputs})
        self._cache[name] = df
        return df

    @property
    def customers(self) -> DataFrame:
        return self.get("raw_customers")

    @property
    def applications(self) -> DataFrame:
        return self.get("raw_applications")

    @property
    def originations(self) -> DataFrame:
        return self.get("raw_originations")

    @property
    def payments(self) -> DataFrame:
        return self.get("raw_payments")

    @property
    def bureau_feed(self) -> DataFrame:
        return self.get("bureau_feed")


def duckdb_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(cte name, sql) pairs for the DuckDB oracle, dependencies first."""
    out: list[tuple[str, str]] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen or n in DRIVER_COLUMNS:
            return
        sql, inputs = RAW_SQL[n]
        for i in inputs:
            visit(i)
        seen.add(n)
        out.append((n, sql.format(**{i: i for i in inputs}).strip()))

    for n in names:
        visit(n)
    return out
