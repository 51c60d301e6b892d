"""Keyed incremental load: late-arrival window, merge by key, month partitions.

Semantics (MERGE ... WHEN MATCHED UPDATE WHEN NOT MATCHED INSERT):

* a batch row whose key exists in the target replaces it; a new key is inserted;
* target rows whose key is absent from the batch are kept (deletes are not
  propagated);
* two batch rows with one key are an error;
* columns new in the batch are appended to the target schema (existing rows
  get NULL), columns missing from the batch are kept (new rows get NULL).

Plain Parquet has no MERGE, so the merge is ``target ANTI JOIN batch keys``
unioned with the batch. :func:`merge_into_partitions` rewrites only the month
partitions a batch touches, including the old month of a key whose date moved.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.session import materialize


DUPLICATE_KEY_MESSAGE = "merge batch has a duplicate key:"


def guard_unique(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch`` unchanged, but evaluating it fails if a non-NULL key occurs twice.

    Only the keys are counted (combined before the shuffle); rows with a NULL
    key are not looked at. The check rides along with whatever job evaluates
    the batch: its one boolean is a scalar subquery.
    """
    keys = list(keys)
    counted = batch.select(*keys).dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    twice = counted.where("__n > 1").agg(F.min(F.to_json(F.struct(*keys))).alias("k")).scalar()
    ok = F.when(twice.isNotNull(),
                F.raise_error(F.concat(F.lit(f"{DUPLICATE_KEY_MESSAGE} "), twice))).otherwise(F.lit(True))
    return batch.where(ok)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], check_unique: bool = True,
           batch_rows: int | None = None, max_broadcast_rows: int = 0) -> DataFrame:
    """Merge ``batch`` into ``target`` by ``keys`` (update matched, insert new).

    With ``check_unique`` evaluating the result fails on a duplicate batch
    key (see :func:`guard_unique`); pass ``False`` for a batch already guarded.
    When the batch row count is known and within ``max_broadcast_rows``, the
    batch keys are broadcast so the (large) target is filtered in place
    instead of being shuffled; otherwise both sides shuffle on the key.
    """
    keys = list(keys)
    if check_unique:
        batch = guard_unique(batch, keys)
    batch_keys = batch.select(*keys)
    if batch_rows is not None and batch_rows <= max_broadcast_rows:
        batch_keys = F.broadcast(batch_keys)
    kept = target.join(batch_keys, keys, "left_anti").select(*target.columns)
    return kept.unionByName(batch, allowMissingColumns=True)


def max_value(target: DataFrame, col: str):
    """Single scalar (bounded result) used as a literal so scans can prune on it."""
    return target.agg(F.max(col).alias("m")).first()["m"]


def lookback_slice(source: DataFrame, target: DataFrame | None, date_col: str,
                   lookback_days: int) -> DataFrame:
    """Rows of ``source`` to (re)load: first run takes everything; later runs take
    ``date_col >= max(target.date_col) - lookback_days``. An existing but
    empty target selects nothing (the maximum is NULL)."""
    if target is None:
        return source
    m = max_value(target, date_col)
    return lookback_slice_from(source, m, date_col, lookback_days)


def lookback_slice_from(source: DataFrame, max_date: dt.date | None, date_col: str,
                        lookback_days: int) -> DataFrame:
    if max_date is None:
        return source.where(F.lit(False))
    start = max_date - dt.timedelta(days=lookback_days)
    return source.where(F.col(date_col) >= F.lit(start))


def month_of(col: str) -> F.Column:
    return F.trunc(F.col(col), "month")


def merge_into_partitions(spark: SparkSession, target_path: str, batch: DataFrame,
                          keys: Sequence[str], date_col: str, partition_col: str = "payment_month",
                          cluster_by: Sequence[str] = (), first_run: bool = False,
                          max_broadcast_rows: int = 0, version_col: str | None = None,
                          check_unique: bool = True) -> None:
    """Merge ``batch`` into the month-partitioned Parquet table at ``target_path``.

    Only months that receive batch rows, or that hold an old version of a
    batch key, are rewritten (dynamic partition overwrite); rows without a date
    are the NULL month. With ``first_run`` the batch replaces the whole table. The
    overwrite replaces a month's files when its job commits, after they have been read,
    so what a month keeps is written once; rows are clustered within each month by
    ``cluster_by`` (min/max statistics then skip row groups).

    With ``version_col`` a batch row replaces an existing one only if its
    version is not older (a NULL version is the oldest), so deliveries may come
    out of order. Without ``check_unique`` the caller vouches for one row a key.

    A crash between the overwrite and the emptying of a month that lost its
    last row leaves that row in both months until the run is repeated.
    """
    keys = list(keys)
    if check_unique:
        batch = guard_unique(batch, keys)

    def write(df: DataFrame, replace: str) -> None:
        out = df
        if cluster_by:
            # Range partitioning on (month, cluster keys): every month is split
            # over several tasks (a month holding most rows is not one task) and
            # each file covers a narrow key range, which row-group statistics skip.
            out = out.repartitionByRange(partition_col, *cluster_by).sortWithinPartitions(
                partition_col, *cluster_by)
        (out.write.mode("overwrite").option("partitionOverwriteMode", replace)
         .partitionBy(partition_col).parquet(target_path))

    def in_months(months: list):
        cond = F.col(partition_col).isin([m for m in months if m is not None])
        return cond | F.col(partition_col).isNull() if None in months else cond

    if first_run:
        write(batch.withColumn(partition_col, month_of(date_col)), "static")
        return

    # The batch is read by several jobs below; write it once (duplicate keys fail here).
    staged = materialize(batch.withColumn(partition_col, month_of(date_col)), "merge_batch")
    target = spark.read.option("mergeSchema", "true").parquet(target_path)
    # Where the batch keys are now (reads key, month and version columns only). A
    # bounded batch is broadcast, so the target's key column is never shuffled.
    batch_keys = staged.select(*keys)
    if max_broadcast_rows and staged.count() <= max_broadcast_rows:
        batch_keys = F.broadcast(batch_keys)
    versions = [version_col] if version_col else []
    old = materialize(target.join(batch_keys, keys, "left_semi").select(*keys, partition_col, *versions), "merge_old")
    if version_col:
        newest = old.groupBy(*keys).agg(F.max(version_col).alias("__version"))
        staged = (staged.join(newest, keys, "left")
                  .where(F.col("__version").isNull() | (F.col(version_col) >= F.col("__version")))
                  .drop("__version"))
        batch_keys = staged.select(*keys)
        old = old.join(batch_keys, keys, "left_semi")
    filled = {r[0] for r in staged.select(partition_col).distinct().collect()}
    left = [r[0] for r in old.select(partition_col).distinct().collect() if r[0] not in filled]
    months = [*filled, *left]
    if not months:
        return
    kept = target.where(in_months(months)).join(batch_keys, keys, "left_anti")
    merged = kept.unionByName(staged, allowMissingColumns=True)
    # of the months without a batch row, those where another row stays
    present = {r[0] for r in kept.where(in_months(left)).select(partition_col).distinct().collect()} if left else set()
    write(merged, "dynamic")
    # A month emptied by the merge (its only rows moved away) is overwritten
    # with no rows, so it contributes nothing to later reads.
    for m in left:
        if m not in present:
            empty = merged.drop(partition_col).where(F.lit(False))
            name = "__HIVE_DEFAULT_PARTITION__" if m is None else m
            empty.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/{partition_col}={name}")
