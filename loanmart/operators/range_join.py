"""Inner/left join of a value against inclusive [lo, hi] ranges.

Small range tables (a catalogue of bands) are broadcast and joined with a
``between`` condition: each task streams its rows past the few bands, no
shuffle of the large side. When the range table is too large to broadcast,
the join becomes an equi-join on blocks of powers of two, followed by the same
``between`` filter: a range lies in at most two neighbouring blocks of the
first power at or over its length, however long it is, and a value stands once
for each power that some range uses (64 at most).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.operators.broadcast import broadcast_if_small


def range_join(left: DataFrame, value: Column, ranges: DataFrame, lo: str, hi: str,
               how: str = "inner", max_broadcast_rows: int = 100_000,
               known_range_rows: int | None = None) -> DataFrame:
    """Join each ``left`` row to the ranges with ``lo <= value <= hi``.

    NULL values and values outside every range find no partner (dropped by an
    inner join, kept with NULL range columns by a left join).
    """
    if how not in ("inner", "left"):
        raise ValueError("range_join supports inner and left joins")
    small, ok = broadcast_if_small(ranges, max_broadcast_rows, known_range_rows)
    if ok:
        return left.join(small, value.between(small[lo], small[hi]), how)

    # Shuffle plan: equi-join on (power, block), then the exact range test.
    level, block = "__range_level", "__range_block"
    length = F.greatest(F.col(hi).cast("double") - F.col(lo).cast("double"), F.lit(0.0)) + 1
    power = F.least(F.ceil(F.log2(length)), F.lit(62)).cast("int")
    block_of = lambda v, p: F.floor(v.cast("double") / F.pow(F.lit(2.0), p))
    placed = ranges.where(F.col(lo) <= F.col(hi)).withColumn(level, power)
    levels = [r[0] for r in placed.select(level).distinct().collect()]
    placed = placed.withColumn(block, F.explode(F.array_distinct(F.array(
        block_of(F.col(lo), F.col(level)), block_of(F.col(hi), F.col(level))))))
    keyed = left.withColumn("__range_value", value)
    matched = (keyed.withColumn(level, F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
               .withColumn(block, block_of(F.col("__range_value"), F.col(level)))
               .join(placed, [level, block])
               .where(F.col("__range_value").between(F.col(lo), F.col(hi))).drop(level, block, "__range_value"))
    if how == "inner":
        return matched
    # rows without a range: those whose value no range holds
    held = (keyed.select("__range_value").distinct()
            .withColumn(level, F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
            .withColumn(block, block_of(F.col("__range_value"), F.col(level)))
            .join(placed, [level, block]).where(F.col("__range_value").between(F.col(lo), F.col(hi)))
            .select("__range_value").distinct())
    rest = keyed.join(held, "__range_value", "left_anti").drop("__range_value")
    return matched.unionByName(rest, allowMissingColumns=True)
