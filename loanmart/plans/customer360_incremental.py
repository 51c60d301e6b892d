"""Customer 360 kept up to date from payment changes instead of rebuilt.

The payment fact is a :class:`~loanmart.operators.keyed_store.KeyedStore` by payment, and
next to it lie the totals of every customer, a KeyedStore by customer. A load

* looks up the rows its batch replaces (bucket by bucket, the stored rows are not
  shuffled) and turns them and the batch into changes: +1 for a row that comes, -1 for
  one that goes;
* adds the changes up per customer (combined before the shuffle) and merges them into
  the totals of the customers they name, which alone are written.

Counts and sums subtract. A maximum does not, so the totals hold how many payments a
customer has for each pair of days past due and severity; what is left when the counts
of a pair reach zero gives the new maximum. A customer has at most as many pairs as
days that a bucket covers.

The totals name the state of the fact they belong to. A load that was interrupted
between the two finds that they differ and builds the totals anew from the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators.keyed_store import KeyedStore
from loanmart.operators.upsert import guard_unique
from loanmart.session import materialize

PAIR = "struct<dpd:bigint,severity:bigint>"


def changes(rows: DataFrame, sign: int) -> DataFrame:
    """Payment rows as changes of their customers' totals."""
    return rows.where("customer_id is not null").select(
        "customer_id", F.lit(sign).cast("bigint").alias("n"), F.col("is_on_time_payment").alias("on_time"),
        F.col("is_delinquent_payment").alias("late"),
        F.struct(F.col("days_past_due").cast("bigint").alias("dpd"), F.col("severity_order").cast("bigint").alias("severity")).alias("pair"))


def added_up(changed: DataFrame) -> DataFrame:
    """Changes per customer: counts, sums, and the non-zero counts of each pair."""
    def of(flag):
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))

    pairs = changed.groupBy("customer_id", "pair").agg(F.sum("n").alias("n"), of("on_time").alias("on_time"), of("late").alias("late"))
    return pairs.groupBy("customer_id").agg(
        F.sum("n").alias("payments"), F.sum("on_time").alias("on_time"), F.sum("late").alias("late"),
        F.sum(F.col("n") * F.col("pair.dpd")).alias("days"),
        F.map_from_entries(F.collect_list(F.when(F.col("n") != 0, F.struct("pair", "n")))).alias("pairs"))


def merged(totals: DataFrame, delta: DataFrame) -> DataFrame:
    """New totals of the customers that ``delta`` names."""
    t, d = totals.alias("t"), delta.alias("d")
    j = d.join(t, F.col("d.customer_id") == F.col("t.customer_id"), "left")
    both = F.map_zip_with(F.coalesce("t.pairs", F.map_from_arrays(F.array().cast(f"array<{PAIR}>"), F.array().cast("array<bigint>"))), F.col("d.pairs"),
                          lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    sums = [(F.coalesce(f"t.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))).alias(c) for c in ("payments", "on_time", "late", "days")]
    return j.select("d.customer_id", *sums, F.map_filter(both, lambda _, n: n != 0).alias("pairs"))


class PaymentTotals:
    """The payment fact and the customers' totals under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark = spark
        self.facts = KeyedStore(spark, f"{root.rstrip('/')}/payments", ["payment_id"], buckets)
        self.totals = KeyedStore(spark, f"{root.rstrip('/')}/totals", ["customer_id"], buckets)

    def rebuild(self) -> None:
        """Totals of the whole fact."""
        self.totals.replace(added_up(changes(self.facts.read(), 1)), {"facts": self.facts.merges})

    def load(self, batch: DataFrame) -> DataFrame | None:
        """Merge a batch of payments; returns the totals it changed (None: all were built anew)."""
        if not self.facts.exists():
            self.facts.merge(batch)
            return self.rebuild()
        if self.totals.extra.get("facts") != self.facts.merges:
            self.rebuild()
        staged = materialize(guard_unique(batch, self.facts.keys), "totals_batch")
        gone = self.facts.read().join(staged.select("payment_id"), "payment_id", "left_semi")
        delta = added_up(changes(staged, 1).unionByName(changes(gone, -1)))
        changed = materialize(merged(self.totals.read(), delta), "totals_changed")
        self.facts.merge_written(staged)
        self.totals.merge_written(changed, {"facts": self.facts.merges})
        return changed

    def summary(self) -> DataFrame:
        """The payment summary of every customer that has payments."""
        keys = F.map_keys("pairs")
        return self.totals.read().where("payments > 0").select(
            "customer_id", F.col("payments").alias("total_payments"), F.col("on_time").alias("on_time_payments"), F.col("late").alias("delinquent_payments"),
            (F.col("days").cast("double") / F.col("payments")).alias("avg_days_past_due"),
            F.array_max(F.transform(keys, lambda k: k["dpd"])).alias("max_days_past_due"),
            F.array_max(F.transform(keys, lambda k: k["severity"])).alias("worst_bucket_ever"))
