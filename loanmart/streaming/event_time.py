"""Payment deliveries by event time: repeats dropped within a watermark, late rows set aside.

Every row carries the time it was delivered. The stream's watermark trails the newest
delivery seen by ``delay``. A row that was seen within that time is a repeat and is
dropped by the stream's state (``dropDuplicatesWithinWatermark``), which forgets rows
once the watermark has passed them, so the state holds the rows of one delay, whatever
the age of the stream. A row older than the watermark can not be told from a repeat any
more; it does not reach the fact.

What the stream took is noted, by micro-batch, in a table of its rows. That write is the
only pass through the stream's state; the merge reads the note, in as many tasks as its
bytes need, and a micro-batch that only forgets rows merges nothing. Rows that landed and
were not taken are the late ones (:func:`late_rows`); a side table keeps them for whoever
has to decide about them. A replayed micro-batch overwrites its own note and merges the
same rows again: both stay what they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanmart.operators import upsert as up
from loanmart.params import DEFAULT, RunParams
from loanmart.plans import facts, intermediate, staging
from loanmart.streaming.payments_stream import RAW_PAYMENT_SCHEMA, VERSION, _table_exists, latest_delivered

KEYS = ["payment_id", VERSION]


def deduplicated(stream: DataFrame, delay: str) -> DataFrame:
    """The stream without repeats and rows older than the watermark."""
    timed = stream.withColumn("delivered_ts", F.col(VERSION).cast("timestamp"))
    return timed.withWatermark("delivered_ts", delay).dropDuplicatesWithinWatermark(KEYS).drop("delivered_ts")


def run_load(spark: SparkSession, landing: str, target: str, taken: str, checkpoint: str, delay: str, buckets: DataFrame,
             p: RunParams = DEFAULT) -> StreamingQuery:
    """Load what has landed since the last run; returns the query once it has ended."""

    def process(batch: DataFrame, epoch: int) -> None:
        note = f"{taken.rstrip('/')}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(note)
        took = spark.read.schema(batch.schema).parquet(note)  # in the caller's session: the batch's one plans without AQE
        if took.isEmpty():
            return
        carry = (VERSION,)
        bucketed = intermediate.payments_bucketed(staging.stg_payments(took, p, carry), buckets, p, carry=carry)
        rows = facts.fct_payments(latest_delivered(bucketed.drop("dbt_loaded_at")), p, [*facts.FCT_PAYMENT_COLUMNS, VERSION])
        up.merge_into_partitions(spark, target, rows, [facts.PAYMENT_KEY], "payment_date", facts.PAYMENT_PARTITION, facts.PAYMENT_CLUSTER,
                                 first_run=not _table_exists(spark, target), max_broadcast_rows=p.max_broadcast_rows, version_col=VERSION,
                                 check_unique=False)  # latest_delivered leaves one row a key

    landed = spark.readStream.schema(RAW_PAYMENT_SCHEMA).parquet(landing)
    query = (deduplicated(landed, delay).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def late_rows(spark: SparkSession, landing: str, taken: str) -> DataFrame:
    """Rows that landed and that no micro-batch took, each once."""
    landed = spark.read.schema(RAW_PAYMENT_SCHEMA).parquet(landing)
    keys = spark.read.schema(landed.select(*KEYS).schema).parquet(taken).select(*KEYS)
    left = landed.join(keys, KEYS, "left_anti")
    return left.groupBy(*KEYS).agg(F.min(F.struct(*[c for c in landed.columns if c not in KEYS])).alias("r")).select(*KEYS, "r.*")
