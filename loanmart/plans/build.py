"""Build every model the way it is deployed; run it again for the next load.

Staging and intermediate models are views (lazy, inlined into their readers);
dimensions, application and origination facts and the customer aggregate are
tables rebuilt in full; seeds go to the seeds database, the calendar (fixed
2020-2030 span) to the shared core database. Two tables keep state between
builds:

* the bureau history in the snapshots database: each build merges one feed
  state into the stored versions (:func:`loanmart.operators.scd2.run_snapshot`);
* the payment fact, partitioned by payment month: each build merges its
  lookback slice, or replaces the whole table with ``full_refresh``.

Tables are written in dependency order and each later model reads the written
tables, so every model is computed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame

from loanmart.operators import scd2
from loanmart.params import RunParams
from loanmart.plans import dims, facts
from loanmart.plans.models import Models, snapshot_input
from loanmart.sources import sinks

VIEWS = ["stg_customers", "stg_applications", "stg_originations", "stg_payments",
         "stg_credit_bureau", "customers_enriched", "applications_outcome", "payments_bucketed"]

# (model attribute, table name, database route)
TABLES = [
    ("buckets", "catalog_delinquency_buckets", "seeds"),
    ("product_catalog", "catalog_products", "seeds"),
    ("bureau_history", "scd_credit_bureau", "snapshots"),
    ("dim_customers", "dim_customers", None),
    ("dim_products", "dim_products", None),
    ("dim_date", "dim_date", "core"),
    ("fct_applications", "fct_applications", None),
    ("fct_originations", "fct_originations", None),
    ("fct_payments", "fct_payments", None),
    ("customer_360", "agg_customer_360", None),
]


def _bureau_history(m: Models, database: str, name: str, bureau: tuple[DataFrame, dt.datetime]) -> str:
    root = sinks.table_path(m.spark, database, f"{name}_runs")
    batch, run_ts = bureau
    scd2.run_snapshot(root, snapshot_input(batch), "customer_id", "report_date", run_ts)
    # what the runs wrote, then the history that follows from it
    runs = sinks.attach_table(m.spark, database, f"{name}_runs", f"{root}/runs")
    m.__dict__["bureau_history"] = scd2.stored_history(m.spark, root)
    m.__dict__["bureau_open"] = scd2.stored_open(m.spark, root)
    qualified = f"`{database}`.`{name}`"
    m.spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS {scd2.history_sql(runs, m.bureau_history.columns, m.spark, root)}")
    return qualified


def _payment_fact(m: Models, database: str, name: str, payments: tuple[DataFrame, RunParams], full_refresh: bool) -> str:
    qualified = f"`{database}`.`{name}`"
    first = full_refresh or not m.spark.catalog.tableExists(qualified)
    path = sinks.table_path(m.spark, database, name)
    facts.incremental_step(m.spark, path, *payments, first_run=first)
    return sinks.attach_table(m.spark, database, name, path)


def build(m: Models, database: str = "analytics", full_refresh: bool = False,
          bureau: tuple[DataFrame, dt.datetime] | None = None,
          payments: tuple[DataFrame, RunParams] | None = None,
          only: Collection[str] | None = None) -> dict[str, str]:
    """Create the views and write the tables; returns model -> view or table name.

    ``bureau`` (feed state, run time) and ``payments`` (bucketed payments, run
    parameters) are the inputs of this load; by default the newest of ``m``.
    ``only`` names the models to build.
    """
    out: dict[str, str] = {}
    for v in VIEWS:
        if only is None or v in only:
            sinks.create_view(getattr(m, v), v)
            out[v] = v
    for attr, table, route in TABLES:
        if only is not None and attr not in only:
            continue
        where = sinks.database_for(database, route)
        if attr == "bureau_history":
            out[attr] = _bureau_history(m, where, table, bureau or m.bureau_batches()[-1])
            continue
        if attr == "fct_payments":
            qualified = _payment_fact(m, where, table, payments or (m.payments_bucketed, m.p), full_refresh)
        elif attr == "dim_date":
            qualified = sinks.write_table(dims.dim_date(dims.calendar_bounds(m.spark), m.holidays, m.p), where, table)
        else:
            qualified = sinks.write_table(getattr(m, attr), where, table)
        # later models read the written table instead of recomputing this one
        m.__dict__[attr] = m.spark.table(qualified).drop(facts.PAYMENT_PARTITION)
        out[attr] = qualified
    return out
