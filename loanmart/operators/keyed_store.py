"""A keyed table stored as bucketed parts, merged without moving what it holds.

The table is a list of parts, oldest first. Every part is bucketed and sorted by the
key in the same way (Spark's ``bucketBy``), so parts join bucket by bucket: the rows
of a part that a later part replaces are found by an anti-join that shuffles
neither. A merge shuffles and writes its batch, as one more part; the rows already
stored are neither read (beyond their keys, if at all) nor written. Readers take of
every part the rows whose key no later part has, which is the merge of
:func:`loanmart.operators.upsert.upsert`:

* a batch row whose key exists replaces it, a new key is inserted, other rows stay;
* two batch rows with one key fail; NULL keys never match and may repeat;
* columns new in a batch are appended (older rows NULL), missing ones stay.

:meth:`KeyedStore.compact` folds all parts into one; a merge does so first if there are
``max_parts`` already. Parts are named by a published state
(:mod:`loanmart.operators.published`): readers see a merge or a compaction as a whole
or not at all.

``buckets`` is the least number of buckets. A table that is written whole (its first
merge, a refresh, a compaction) gets as many as its rows need, and a table whose buckets
have outgrown their size is compacted into more before the next merge: what one task
holds does not grow with the table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators.published import publish, published
from loanmart.operators.upsert import guard_unique
from loanmart.session import materialize

# Rows of a bucket when a table is written whole. It may grow to twice as many before the
# table is dealt anew, into buckets of half as many.
BUCKET_ROWS = 500_000


class KeyedStore:
    """The table under ``root`` (a shared folder), created by its first merge."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 8, max_parts: int = 4):
        self.spark, self.root, self.keys, self.max_parts = spark, root.rstrip("/"), list(keys), max_parts
        self.version, state = published(spark, self.root)
        self.parts: list[str] = state["parts"] if state else []
        self.buckets: int = state["buckets"] if state else buckets
        self.rows: int = state.get("rows", 0) if state else 0  # of all parts, replaced ones included
        self.merges: int = state["merges"] if state else 0  # merges and refreshes so far
        self.extra: dict = state.get("extra", {}) if state else {}  # what the last writer noted with its state
        if state and state["keys"] != self.keys:
            raise ValueError(f"{root} is keyed by {state['keys']}")

    # --- parts ------------------------------------------------------------------
    def _database(self) -> str:
        name = f"keyed_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/tables'")
        return name

    def _part(self, name: str) -> DataFrame:
        """A part as a bucketed table; a session that did not write it registers it first."""
        table = f"`{self._database()}`.`{name}`"
        if not self.spark.catalog.tableExists(table):
            path = f"{self.root}/parts/{name}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def _write(self, df: DataFrame) -> str:
        name = f"part_{uuid.uuid4().hex[:12]}"
        table = f"`{self._database()}`.`{name}`"
        # one file for each bucket
        dealt = df.repartition(self.buckets, *self.keys)
        (dealt.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", f"{self.root}/parts/{name}").saveAsTable(table))
        return name

    def _publish(self, parts: list[str], merges: int, extra: dict, rows: int) -> None:
        publish(self.spark, self.root, self.version + 1,
                {"parts": parts, "keys": self.keys, "buckets": self.buckets, "rows": rows, "merges": merges, "extra": extra})
        self.version, self.parts, self.merges, self.extra, self.rows = self.version + 1, parts, merges, extra, rows

    def _write_whole(self, df: DataFrame, rows: int, spare: int = 1) -> str:
        """Write the only part of the table, with ``spare`` times the buckets its rows need."""
        self.buckets = max(self.buckets, -(-rows * spare // BUCKET_ROWS))
        return self._write(df)

    def _make_room(self, rows: int) -> None:
        """Compact before a part of so many rows if there are too many parts or too few buckets."""
        outgrown = self.rows + rows > 2 * BUCKET_ROWS * self.buckets
        if outgrown or len(self.parts) >= self.max_parts:
            self.compact(rows if outgrown else None)

    # --- readers and writers ------------------------------------------------------
    def exists(self) -> bool:
        return bool(self.parts)

    def read(self) -> DataFrame | None:
        """The rows of the table as published when this object last read or wrote its state."""
        if not self.parts:
            return None
        tables = [self._part(p) for p in self.parts]
        current = []
        for k, rows in enumerate(tables):
            for later in tables[k + 1:]:
                rows = rows.join(later.select(*self.keys), self.keys, "left_anti")
            # the columns of the newest parts come last, as a merge appends them
            current.append(rows.select(*tables[k].columns))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), current)

    def merge(self, batch: DataFrame, extra: dict | None = None) -> None:
        """Merge a batch by key; ``extra`` is published with it."""
        self.merge_written(materialize(guard_unique(batch, self.keys), "keyed_batch"), extra)

    def merge_written(self, batch: DataFrame, extra: dict | None = None) -> None:
        """Merge a batch that is a written table (counting its rows is cheap) without repeated keys."""
        rows = batch.count()
        if not self.parts:
            return self._publish([self._write_whole(batch, rows)], self.merges + 1, extra or {}, rows)
        self._make_room(rows)
        self._publish([*self.parts, self._write(batch)], self.merges + 1, extra or {}, self.rows + rows)

    def replace(self, rows: DataFrame, extra: dict | None = None) -> None:
        """Full refresh: the rows are the whole table."""
        written = materialize(guard_unique(rows, self.keys), "keyed_batch")
        n = written.count()
        self._publish([self._write_whole(written, n)], self.merges + 1, extra or {}, n)

    def compact(self, room: int | None = None) -> None:
        """Fold all parts into one; the table's rows stay what they are. With ``room`` the
        buckets are made for so many rows more, and filled by half."""
        if len(self.parts) > 1 or room is not None and self.parts:
            whole = self.read()
            part = self._write_whole(whole, self.rows) if room is None else self._write_whole(whole, self.rows + room, 2)
            self._publish([part], self.merges, self.extra, self._part(part).count())

    def max_value(self, column: str):
        """Greatest value of a column (one scalar), or None for an empty table."""
        rows = self.read()
        return None if rows is None else rows.agg(F.max(column)).first()[0]
