"""A keyed table partitioned by month, rewritten one touched month at a time and published whole.

A merge writes the months it touches, once, into a folder of its own run; the table's
state names the run that holds each month. Readers of the old state keep reading the old
folders, so no reader ever sees a row in two months or in none, and a failed merge leaves
nothing but unread files. A month that a merge empties is no longer named.

Rows of a month are ordered by the interleaved ranks of the cluster columns
(:mod:`loanmart.operators.clustering`) and dealt by ranges of (month, order): a month that
holds most rows is written by many tasks.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.operators.clustering import border_aggregates, interleaved
from loanmart.operators.published import publish, published
from loanmart.operators.upsert import guard_unique, month_of
from loanmart.session import materialize

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PartitionStore:
    """The table under ``root`` (a shared folder), created by its first merge."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], date_col: str, month_col: str = "payment_month",
                 cluster_by: Sequence[str] = (), max_broadcast_rows: int = 0):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.date_col, self.month_col, self.cluster_by, self.max_broadcast_rows = date_col, month_col, list(cluster_by), max_broadcast_rows
        self.version, state = published(spark, self.root)
        self.runs: dict[str, int] = state["months"] if state else {}  # month (or "") -> run
        self.schema = T.StructType.fromJson(json.loads(state["schema"])) if state else None

    def exists(self) -> bool:
        return self.version > 0

    def read(self, months: Sequence[str] | None = None) -> DataFrame:
        """The table as published when this object last read or wrote its state."""
        wanted = [m for m in self.runs if months is None or m in months]
        paths = [f"{self.root}/rows/run={self.runs[m]}/{self.month_col}={m or _NULL_FOLDER}" for m in wanted]
        stored = T.StructType([*self.schema.fields, T.StructField("run", T.LongType())])
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/rows").parquet(*paths).drop("run")

    def newest_date(self) -> dt.date | None:
        """Greatest date of the table: that of its last month."""
        dated = [m for m in self.runs if m]
        return self.read([max(dated)]).agg(F.max(self.date_col)).first()[0] if dated else None

    def _write(self, rows: DataFrame, borders: Sequence[list | None]) -> list[str]:
        """Write the rows as this version's run; returns the months that have any."""
        if self.cluster_by:
            rows = rows.withColumn("_order", interleaved(rows, self.cluster_by, borders))
            rows = rows.repartitionByRange(self.month_col, "_order").sortWithinPartitions(self.month_col, "_order").drop("_order")
        path = f"{self.root}/rows/run={self.version + 1}"
        rows.write.mode("overwrite").partitionBy(self.month_col).parquet(path)
        present = self.spark.read.schema(rows.schema).parquet(path).select(self.month_col).distinct().collect()
        return ["" if m is None else m.isoformat() for (m,) in present]

    def _publish(self, months: dict[str, int], schema: T.StructType) -> None:
        publish(self.spark, self.root, self.version + 1, {"months": months, "schema": schema.json()})
        self.version, self.runs, self.schema = self.version + 1, months, schema

    def replace(self, rows: DataFrame) -> None:
        """Full refresh: the rows are the whole table."""
        rows = guard_unique(rows, self.keys).withColumn(self.month_col, month_of(self.date_col))
        borders = rows.agg(*border_aggregates(rows, self.cluster_by)).first() if self.cluster_by else []
        present = self._write(rows, borders)
        self._publish({m: self.version + 1 for m in present}, rows.schema)

    def merge(self, batch: DataFrame) -> None:
        """Merge a batch by key (see :func:`loanmart.operators.upsert.upsert`); NULL dates are a month."""
        if not self.exists():
            return self.replace(batch)
        staged = materialize(guard_unique(batch, self.keys).withColumn(self.month_col, month_of(self.date_col)), "merge_batch")
        facts = staged.agg(F.count(F.lit(1)), F.collect_set(self.month_col), F.max(F.col(self.month_col).isNull()), *border_aggregates(staged, self.cluster_by)).first()
        rows, touched, undated, borders = facts[0], {m.isoformat() for m in facts[1]}, facts[2], facts[3:]
        if not rows:
            return
        keys = staged.select(*self.keys)
        if rows <= self.max_broadcast_rows:
            keys = F.broadcast(keys)
        table = self.read()
        # the months that hold a version of a batch key now: key columns only
        held = table.join(keys, self.keys, "left_semi").select(self.month_col).distinct().collect()
        touched |= {"" if m is None else m.isoformat() for (m,) in held} | ({""} if undated else set())
        merged = self.read(list(touched)).join(keys, self.keys, "left_anti").select(*self.schema.names).unionByName(staged, allowMissingColumns=True)
        present = self._write(merged, borders)
        months = {m: r for m, r in self.runs.items() if m not in touched}
        self._publish(months | {m: self.version + 1 for m in present}, merged.schema)
