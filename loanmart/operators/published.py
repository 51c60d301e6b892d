"""Publication of a table's state: which of its folders readers look at.

A state is one row in one Parquet file in a numbered folder of its own, written after
the data it names. The file appears by a single rename, so readers see the state
before or the one after, never a table half written, and an interrupted writer leaves
the published state as it was. One writer at a time; readers at any time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "version bigint, state string"


def published(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """Number and content of the newest published state; (0, None) before the first."""
    try:
        states = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root.rstrip('/')}/states")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0, None
        raise
    newest = states.agg(F.max_by("state", "version"), F.max("version")).first()
    return (0, None) if newest[1] is None else (newest[1], json.loads(newest[0]))


def publish(spark: SparkSession, root: str, version: int, state: dict) -> None:
    """Make ``state`` the newest one; ``version`` is the number that :func:`published` gave, plus one."""
    row = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(json.dumps(state)).alias("state"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/states/{version:010d}")
