"""Uniqueness of a key over batches that arrive one after the other.

Checking a growing table for repeated keys by grouping all of it costs the whole table
every time. Here every batch leaves a 64-bit fingerprint of each of its keys in a table
bucketed by fingerprint. A new batch joins its own fingerprints with the stored ones
bucket by bucket (only the batch is shuffled); a match names the older batch that may
hold the key. Only those batches are read again, and only for the suspected keys, to
confirm what the fingerprints suggest: the result is exact.

A key is a combination of columns; NULLs take part like any other value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators.keyed_store import KeyedStore
from loanmart.session import dealt, materialize

PRINT, BATCH = "key_print", "batch"


class UniqueKeys(KeyedStore):
    """Fingerprints of the batches checked so far, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], buckets: int = 8, max_parts: int = 8):
        super().__init__(spark, root, [PRINT], buckets, max_parts)
        self.columns = list(columns)

    def read(self) -> DataFrame | None:
        """(key_print, batch) of all batches; unlike a merged table, no part replaces another."""
        tables = [self._part(p).select(PRINT, BATCH) for p in self.parts]
        return reduce(DataFrame.unionByName, tables) if tables else None

    def _suspects(self, prints: DataFrame) -> DataFrame | None:
        """(key_print, batch) of stored prints that the batch has too."""
        found = [self._part(p).select(PRINT, BATCH).join(prints, PRINT, "left_semi") for p in self.parts]
        return materialize(reduce(DataFrame.unionByName, found), "suspects") if found else None

    def check(self, batch: DataFrame, name: str, older: Callable[[list[str]], DataFrame]) -> DataFrame:
        """Keys of the batch that occur more than once in it and the batches before: the key
        columns and ``n_records``. Then the batch counts among those before.

        ``older(names)`` reads the rows of the named earlier batches. A batch that was checked
        before under this name is not checked against itself, nor noted again.
        """
        printed = batch.select(*self.columns, F.xxhash64(*self.columns).alias(PRINT))
        own = dealt(printed, batch.count(), PRINT).groupBy(PRINT, *self.columns).agg(F.count(F.lit(1)).alias("n_records"))
        own = materialize(own.select(*self.columns, "n_records", PRINT), "batch_keys")
        n_own = own.count()
        suspects = self._suspects(own.select(PRINT))
        again, total = False, own
        if suspects is not None:
            names = {r[0] for r in suspects.select(BATCH).distinct().collect()}  # at most one for each batch
            again = name in names
            names.discard(name)
            if names:
                # met by fingerprint alone, then grouped by the keys, so NULLs meet too
                met = suspects.where(F.col(BATCH) != name).select(PRINT)
                rows = older(sorted(names)).select(*self.columns, F.xxhash64(*self.columns).alias(PRINT))
                most = max(self.rows, n_own)
                rows = dealt(rows, most, PRINT).join(dealt(met, most, PRINT), PRINT, "left_semi")
                both = own.withColumn("own", F.lit(True)).unionByName(rows.withColumn("n_records", F.lit(1).cast("bigint")).withColumn("own", F.lit(False)))
                total = dealt(both, most + n_own, PRINT).groupBy(PRINT, *self.columns).agg(F.sum("n_records").alias("n_records"), F.max("own").alias("own"))
                total = total.where("own")
        out = materialize(total.where("n_records > 1").select(*self.columns, "n_records"), "repeated_keys")
        if not again:
            # keys that share a fingerprint leave it once each: a part may repeat a print
            self.merge_written(own.select(PRINT, F.lit(name).alias(BATCH)))
        return out
