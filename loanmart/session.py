"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on. UTC keeps date <-> timestamp casts
# stable; AQE coalesces small shuffles and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "loanmart") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LOANMART_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the models depend on (safe on an existing session)."""
    for k, v in SESSION_CONF.items():
        if k == "spark.ui.enabled":
            continue
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without that setting (tests) gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_uuid(current.rsplit("/", 1)[-1]) else current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="loanmart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def _is_uuid(s: str) -> bool:
    try:
        uuid.UUID(s)
        return True
    except ValueError:
        return False


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a DataFrame reading it back.

    Cuts the lineage in one pass (``DataFrame.checkpoint`` evaluates its plan
    twice: once to count, once to write), stores columnar data that later
    scans can prune, and survives executor loss because the files live in the
    shared folder rather than on an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    # the schema is known: reading it back needs no schema-inference job
    return spark.read.schema(df.schema).parquet(path)


# Rows that one task of a shuffle is to hold at most.
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as ``rows`` rows need, if the session's number of
    shuffle partitions would give a task more; else ``df`` as it is (Spark deals it itself)."""
    needed = -(-rows // ROWS_PER_TASK)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(needed, *keys) if needed > usual else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Lineage cut used between the runs of a stateful load (see :func:`materialize`)."""
    return materialize(df, "cut")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/loanmart-tables/{name}-{uuid.uuid4().hex[:12]}"
