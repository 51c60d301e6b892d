"""Sinks: views, full-rebuild tables, and routing of tables to databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanmart.session import materialize

# Database suffix per kind of table (models of the core marts use the base name).
ROUTES = {"seeds": "seeds", "snapshots": "snapshots", "core": "core"}


def database_for(base: str, kind: str | None) -> str:
    """`base` for marts; `<base>_<route>` for seeds, snapshots and shared dimensions."""
    return base if kind is None else f"{base}_{ROUTES[kind]}"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_view(df: DataFrame, name: str) -> None:
    """A view is a named lazy DataFrame: evaluated by every query that reads it."""
    df.createOrReplaceTempView(name)


def write_table(df: DataFrame, database: str, name: str, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Full rebuild of a catalog table (overwrite); returns the qualified name.

    A table that exists may be among the inputs: its new rows are written to
    the scratch folder before it is replaced.
    """
    spark = df.sparkSession
    ensure_database(spark, database)
    qualified = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(qualified):
        df = materialize(df, name)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(qualified)
    return qualified


def table_path(spark: SparkSession, database: str, name: str) -> str:
    """Folder of a table that jobs write by path."""
    ensure_database(spark, database)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


def attach_table(spark: SparkSession, database: str, name: str, path: str) -> str:
    """Catalog entry of a partitioned Parquet folder, with the partitions it has now."""
    ensure_database(spark, database)
    qualified = f"`{database}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    spark.sql(f"CREATE TABLE {qualified} USING parquet LOCATION '{path}'")
    spark.catalog.recoverPartitions(qualified)
    return qualified
