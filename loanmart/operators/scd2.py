"""Type-2 history (timestamp strategy) merged one source batch at a time.

History columns: the tracked columns, plus

* ``dbt_scd_id``     md5 of key and start of validity
* ``dbt_updated_at`` the source's update timestamp of the version
* ``dbt_valid_from`` start of validity (the update timestamp, but for returning keys)
* ``dbt_valid_to``   end of validity, NULL for the open (current) version

Rules for one batch (the batch has at most one row per key):

* new key -> open a version at its update timestamp;
* open version and the batch row is newer (update timestamp past the version's
  ``dbt_updated_at``) -> close it at the new timestamp and open a new version;
  not newer -> nothing changes (other columns are not compared);
* open version whose key is missing from the batch -> closed at the run time
  (hard delete), when ``invalidate_hard_deletes`` is on;
* key that returns after a delete -> a version opens at its update timestamp if
  that is past the delete, else at the run time: validity intervals of one key
  never overlap, and ``dbt_scd_id`` (key and start of validity) stays unique;
* closed versions are never touched.

An open version whose start lies past the run time is void once its key is missing: it
was never valid, and leaves no version.

A stored history (:func:`run_snapshot`) is one Parquet table partitioned by run and by
what the run did. A run writes only its changes: the versions it opened and those it
closed (a void one as an empty interval). Of the rows of one ``dbt_scd_id`` the newest
run's counts. :func:`compact` folds the open versions of all runs so far into a base,
published as a whole (:mod:`loanmart.operators.published`); current versions are then
that base and the runs after it, still one scan. Closed versions are never rewritten.
Running a run again gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.operators.published import publish, published
from loanmart.session import materialize

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _scd_id(key: Column, updated: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")),
                             F.coalesce(updated.cast("string"), F.lit(""))))


def empty_history(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """A history with no versions and the schema ``merge`` produces for ``batch``."""
    return initial_history(batch.where(F.lit(False)), key, updated_at)


def initial_history(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """First snapshot run: every batch row opens a version."""
    upd = F.col(updated_at).cast("timestamp")
    return batch.select(
        *batch.columns,
        _scd_id(F.col(key), upd).alias("dbt_scd_id"),
        upd.alias("dbt_updated_at"),
        upd.alias("dbt_valid_from"),
        F.lit(None).cast(T.TimestampType()).alias("dbt_valid_to"),
    )


def merge(history: DataFrame, batch: DataFrame, key: str, updated_at: str,
          run_ts: dt.datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """Apply one source batch to a type-2 history; returns the new history."""
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    open_ = history.where(F.col("dbt_valid_to").isNull())
    return closed.unionByName(merge_open(open_, closed, batch, key, updated_at, run_ts, invalidate_hard_deletes))


def merge_open(open_: DataFrame, closed: DataFrame, batch: DataFrame, key: str, updated_at: str,
               run_ts: dt.datetime, invalidate_hard_deletes: bool = True, changes_only: bool = False) -> DataFrame:
    """Merge one batch into the *open* versions only.

    Returns the versions this run touches or keeps open: open versions left
    unchanged, versions it closes, and versions it opens. Of the closed versions
    only key and end of validity are read, for batch keys without an open version.
    With ``changes_only`` unchanged versions are left out, and a version that turns out
    void is an empty interval.
    """
    cols = [c for c in open_.columns if c not in META]
    unmatched = batch.select(key).join(open_.select(key), key, "left_anti")
    gone = (closed.select(key, "dbt_valid_to").join(unmatched, key, "left_semi")
            .groupBy(key).agg(F.max("dbt_valid_to").alias("__gone_at")))
    h = open_.alias("h")
    s = batch.select(*cols).join(gone, key, "left").alias("s")
    j = h.join(s, F.col(f"h.{key}") == F.col(f"s.{key}"), "full_outer")

    h_key, s_key = F.col(f"h.{key}"), F.col(f"s.{key}")
    s_upd, gone_at = F.col(f"s.{updated_at}").cast("timestamp"), F.col("s.__gone_at")
    newer = s_upd > F.col("h.dbt_updated_at")
    run = F.lit(run_ts).cast("timestamp")
    opens_at = (F.when(h_key.isNotNull(), F.greatest(s_upd, F.col("h.dbt_valid_from")))
                .when(gone_at.isNull() | (s_upd >= gone_at), s_upd).otherwise(run))

    close_at = F.when(s_key.isNotNull() & newer, opens_at)
    if invalidate_hard_deletes:
        close_at = F.when(s_key.isNull(), run).otherwise(close_at)

    # a version that would end where it starts is replaced by its successor, under the same id
    kept = close_at.isNull() | (close_at > F.col("h.dbt_valid_from"))
    if changes_only:
        kept = close_at.isNotNull() & (s_key.isNull() | (close_at > F.col("h.dbt_valid_from")))
    old_version = F.when(h_key.isNotNull() & kept, F.struct(
        *[F.col(f"h.{c}").alias(c) for c in cols],
        F.col("h.dbt_scd_id").alias("dbt_scd_id"),
        F.col("h.dbt_updated_at").alias("dbt_updated_at"),
        F.col("h.dbt_valid_from").alias("dbt_valid_from"),
        close_at.alias("dbt_valid_to"),
    ))
    new_version = F.when(s_key.isNotNull() & (h_key.isNull() | newer), F.struct(
        *[F.col(f"s.{c}").alias(c) for c in cols],
        _scd_id(s_key, opens_at).alias("dbt_scd_id"),
        s_upd.alias("dbt_updated_at"),
        opens_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    ))
    return j.select(F.inline(F.array_compact(F.array(old_version, new_version))))


def current(history: DataFrame) -> DataFrame:
    """Open versions only (the state as of the last run)."""
    return history.where(F.col("dbt_valid_to").isNull())


def as_of(history: DataFrame, ts: Column) -> DataFrame:
    """Version valid at ``ts`` for each key: valid_from <= ts < coalesce(valid_to, +inf)."""
    return history.where((F.col("dbt_valid_from") <= ts) &
                         (F.col("dbt_valid_to").isNull() | (ts < F.col("dbt_valid_to"))))


def replay(batches: Sequence[tuple[DataFrame, dt.datetime]], key: str, updated_at: str,
           invalidate_hard_deletes: bool = True) -> DataFrame:
    """Apply batches in order and return the final history.

    Each step is written once: the next one reads it several times.
    """
    if not batches:
        raise ValueError("no batches")
    out = None
    for batch, run_ts in batches:
        out = materialize(initial_history(batch, key, updated_at) if out is None
                          else merge(out, batch, key, updated_at, run_ts, invalidate_hard_deletes), "history")
    return out


# --- stored history -----------------------------------------------------------

RUN, PART = "snapshot_run", "part"
OPENED, CLOSED, BASE = "opened", "closed", "base"


def run_id(run_ts: dt.datetime) -> str:
    """Partition value of a run; sorts in time order."""
    return run_ts.strftime("%Y%m%dT%H%M%S")


def _stored(spark: SparkSession, root: str, schema: T.StructType | None) -> DataFrame | None:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType()),
                                             T.StructField(PART, T.StringType())]))
    try:
        return reader.parquet(f"{root.rstrip('/')}/runs")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _base(spark: SparkSession, root: str) -> dict:
    """Run up to which versions are folded, and where; before the first one an empty base."""
    return published(spark, root)[1] or {"run": "", "at": ""}


def _since(base: dict) -> Column:
    return (F.col(RUN) == base["at"]) | ((F.col(RUN) > base["run"]) & (F.col(PART) != BASE))


def _newest(stored: DataFrame, base: dict) -> DataFrame:
    """The newest row of every version that is open in the base or touched by a later run."""
    cols = [c for c in stored.columns if c not in (RUN, PART)]
    latest = stored.where(_since(base)).groupBy("dbt_scd_id").agg(F.max_by(F.struct(*cols), RUN).alias("v"))
    return latest.select(*[F.col(f"v.{c}").alias(c) for c in cols])


def _ended() -> Column:
    return (F.col(PART) == CLOSED) & (F.col("dbt_valid_to") > F.col("dbt_valid_from"))


def run_snapshot(root: str, batch: DataFrame, key: str, updated_at: str, run_ts: dt.datetime,
                 invalidate_hard_deletes: bool = True) -> None:
    """One scheduled run: merge the batch into the history stored under ``root``.

    Reads the runs before ``run_ts`` and writes this run's changes, replacing what an
    earlier attempt at this run wrote.
    """
    spark = batch.sparkSession
    this = run_id(run_ts)
    version, state = published(spark, root)
    if state and state["run"] >= this:  # a folded run is run again: its base no longer counts
        publish(spark, root, version + 1, {"run": "", "at": ""})
    first = initial_history(batch, key, updated_at)
    stored = _stored(spark, root, first.schema)
    before = stored.where(F.col(RUN) < this) if stored is not None else None
    if before is None or before.isEmpty():
        step = first
    else:
        batch = materialize(batch, "snapshot_batch")  # the merge reads it twice
        open_ = _newest(before, _base(spark, root)).where("dbt_valid_to is null")
        closed = before.where(_ended()).drop(RUN, PART)
        step = merge_open(open_, closed, batch, key, updated_at, run_ts, invalidate_hard_deletes, changes_only=True)
    part = F.when(F.col("dbt_valid_to").isNull(), OPENED).otherwise(CLOSED)
    (step.withColumn(PART, part)
     .write.mode("overwrite").partitionBy(PART).parquet(f"{root.rstrip('/')}/runs/{RUN}={this}"))


def compact(spark: SparkSession, root: str, schema: T.StructType | None = None) -> None:
    """Fold the open versions of all runs so far into a new base. Readers use it once it is
    published; the rows it stands for stay until their files are removed."""
    stored = _stored(spark, root, schema)
    last = None if stored is None else stored.where(F.col(PART) != BASE).agg(F.max(RUN)).first()[0]
    if last is None:
        return
    version, _ = published(spark, root)
    at = f"{last}-{version + 1:06d}"  # sorts after its run and before the next one
    current = _newest(stored, _base(spark, root)).where("dbt_valid_to is null")
    current.write.mode("overwrite").parquet(f"{root.rstrip('/')}/runs/{RUN}={at}/{PART}={BASE}")
    publish(spark, root, version + 1, {"run": last, "at": at})


def history_sql(runs: str, columns: Sequence[str], spark: SparkSession, root: str) -> str:
    """The whole history as SQL over a catalog table of the runs' folder, as published now."""
    base, cols = _base(spark, root), ", ".join(f"`{c}`" for c in columns)
    return f"""SELECT {cols} FROM {runs} WHERE {PART} = '{CLOSED}' AND dbt_valid_to > dbt_valid_from
UNION ALL SELECT v.* FROM (SELECT max_by(struct({cols}), {RUN}) AS v FROM {runs}
  WHERE {RUN} = '{base["at"]}' OR ({RUN} > '{base["run"]}' AND {PART} <> '{BASE}') GROUP BY dbt_scd_id) WHERE v.dbt_valid_to IS NULL"""


def stored_history(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole history: the versions closed by all runs and the open ones."""
    closed = _stored(spark, root, schema).where(_ended())
    return closed.drop(RUN, PART).unionByName(stored_open(spark, root, schema))


def stored_open(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Current versions: one scan of the base and the runs after it."""
    return _newest(_stored(spark, root, schema), _base(spark, root)).where("dbt_valid_to is null")


def deleted_keys(history: DataFrame, key: str) -> DataFrame:
    """Last version of every key that has no open version (deleted at the source).

    The latest version per key is found with ``max_by`` (partial aggregation),
    so a key with very many versions is not sorted in a single task.
    """
    open_keys = history.where(F.col("dbt_valid_to").isNull()).select(key)
    cols = [c for c in history.columns if c != key]
    latest = (history.join(open_keys, key, "left_anti").groupBy(key)
              .agg(F.max_by(F.struct(*cols), F.col("dbt_valid_from")).alias("v")))
    return latest.select(key, *[F.col(f"v.{c}").alias(c) for c in cols])
