"""As-of join: each event with the version of its key that holds at the event's time.

A sweep, not a range join: events and versions are one stream of rows, ordered by key
and time, and the last version seen is carried forward to the events after it. No pair
of an event and a version is formed but the wanted one.

The stream is dealt by ranges of (key, time), so a key with very many events is spread
over several tasks. Inside a range the carry is a window; the version to start a range
with is the last one of the key's earlier ranges, found from one row for each key and
range that they share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.session import materialize


def asof_join(events: DataFrame, versions: DataFrame, key: str, event_time: str, valid_from: str,
              valid_to: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Every event, with ``columns`` of the last version of its key that starts at or before it.

    With ``valid_to`` a version that has ended by the event's time does not hold (NULL: it has
    no end); the event then has NULLs, as one before the first version or with a NULL key or
    time. Versions without a key or start are not looked at. Of versions of one key that start
    together the greatest by (valid_to, columns) is taken, an open one last. Columns of the
    result: those of the events, then the versions' ``columns``.
    """
    columns = columns or [c for c in versions.columns if c != key]
    kind = versions.schema[key].dataType
    ends = F.col(valid_to) if valid_to else F.lit(None).cast("timestamp")
    carried = F.struct(ends.alias("ends"), F.struct(*columns).alias("v"))
    rank = F.struct(ends.isNull().alias("open"), ends.alias("ends"), F.struct(*columns).alias("v"))
    starts = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).cast("timestamp").alias("_time"), F.lit(0).alias("_kind"), rank.alias("_rank"), carried.alias("_version"),
        F.lit(None).cast(events.schema).alias("_event"))
    moments = events.select(F.col(key).cast(kind).alias("_key"), F.col(event_time).cast("timestamp").alias("_time"), F.lit(1).alias("_kind"),
                            F.lit(None).cast(starts.schema["_rank"].dataType).alias("_rank"), F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"), F.struct(*events.columns).alias("_event"))
    order = ["_time", "_kind", "_rank"]  # a version holds from its start on
    stream = starts.unionByName(moments).repartitionByRange("_key", *order).withColumn("_range", F.spark_partition_id())
    stream = materialize(stream, "asof")

    # the version each range of a key starts with
    last = stream.groupBy("_key", "_range").agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_time", "_rank"))).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = last.select(F.col("_key").alias("_of"), F.col("_range").alias("_at"), F.last("_last", ignorenulls=True).over(before).alias("_first"))

    within = Window.partitionBy("_key", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = stream.join(first, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
    swept = swept.withColumn("_now", F.coalesce(F.last("_version", ignorenulls=True).over(within), "_first")).where("_kind = 1")
    holds = F.col("_key").isNotNull() & F.col("_time").isNotNull() & (F.col("_now.ends").isNull() | (F.col("_time") < F.col("_now.ends")))
    return swept.select("_event.*", *[F.when(holds, F.col(f"_now.v.{c}")).alias(c) for c in columns])
