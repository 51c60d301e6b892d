"""Row order for pruning on any of several columns: interleaved bits of their ranks.

Sorting by (a, b, c) leaves b and c unordered across files. Here every column's values
are numbered by rank (which of 2**bits equal parts of the column a value falls into) and
the bits of the numbers are interleaved, most significant first. Rows close in that
order are close in all columns, so each file covers a narrow range of every column and
its minimum and maximum rule it out for predicates on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Equal parts of a column: 2**BITS.
BITS = 4


def number(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order; strings by their first seven bytes."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    return value.cast("double")


def border_aggregates(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """Aggregates that give each column's borders: one approximate quantile for each part."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    return [F.percentile_approx(number(df, c), shares, 1000).alias(f"_borders_{k}") for k, c in enumerate(columns)]


def interleaved(df: DataFrame, columns: Sequence[str], borders: Sequence[list | None], bits: int = BITS) -> Column:
    """Position of a row in the interleaved order; ``borders`` as the aggregates above gave them.

    NULLs count as the least value. Borders may come from other rows than ``df``'s: they only
    decide how even the parts are.
    """
    ranks = []
    for c, marks in zip(columns, borders):
        value = number(df, c)
        # as one array: the generated code is the same for any borders, so it is compiled once
        ordered = F.array(*map(F.lit, sorted(marks or [])))
        above = [F.when(value >= ordered[k], 1).otherwise(0) for k in range(len(marks or []))]
        ranks.append(sum(above, F.lit(0)).cast("long"))
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            place = bit * len(columns) + (len(columns) - 1 - k)
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), place))
    return out
