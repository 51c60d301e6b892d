"""Shared helpers: table access, scratch tables, Arrow text as numpy bytes, word hashes.

Text helpers work on the UTF-8 bytes of an Arrow string column. A NULL text counts as
an empty one. Words are maximal runs of the bytes allowed by a 256-entry table; bytes
of multi-byte characters are word bytes in both tables used here, so a run of bytes is
a run of characters.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanmart.session import materialize, scratch_path  # noqa: F401  (re-exported)

#: Text bytes handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of rows sent to a Python worker at once; 10,000 rows of long texts would be gigabytes.
BATCH_BYTES = 16 << 20


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: as a py-file, unless PYTHONPATH already has it.

    Also bounds the bytes of the batches that they get.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_loanmart_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="loanmart-py-"), "loanmart_pkg"), "zip", root, "loanmart"))
    sc._loanmart_shipped = True


def schema_with(df: DataFrame, more: str) -> StructType:
    """Columns of df, then those of a DDL list."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def crc_bucket(col, n: int):
    """crc32 of an id as text, modulo n (a NULL id counts as the empty text)."""
    return (F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def one_text(rows: DataFrame) -> DataFrame:
    """One row for each (doc_id, _y): of several texts of an id that with the smallest hash."""
    first = F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("t")
    return rows.groupBy("doc_id", "_y").agg(first).select("doc_id", F.col("t._text").alias("_text"), "_y")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- text as bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+  (after lower-casing: digits, a-z, all beyond ASCII)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of row ranges of at most ``limit`` bytes (or one row)."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of every row, and the row of each word."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = allowed[data]
    edge = np.zeros(n + 1, bool)
    edge[1:] = inside[1:] != inside[:-1]
    edge[0] = inside[0]
    edge[offsets] |= inside[offsets]  # a word does not cross rows
    at = np.flatnonzero(edge)
    first = inside[at]
    starts = at[first]
    # the next edge ends the word; a row border may be both an end and a start
    ends = np.append(at, n)[np.flatnonzero(first) + 1]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**j and BASE**-j modulo 2**64 for j < n; kept for the next block."""
    if len(_POWERS[0]) < n:
        n = max(n, min(2 * len(_POWERS[0]), BLOCK_BYTES + 1))  # as many as the blocks need
        for k, b in enumerate((BASE, BASE_INV)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the result depends on every bit of h."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of one running polynomial sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts])


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each window of ``width`` successive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * BASE + words[k : k + n]
    return mix(h)


def hash_text(text: str) -> int:
    """Hash of a short text as :func:`span_hashes` gives it."""
    b = np.frombuffer(text.encode(), np.uint8)
    return int(span_hashes(b, np.array([0]), np.array([len(b)]))[0]) if len(b) else int(mix(np.zeros(1, np.uint64))[0])


def segment_arange(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for each length, concatenated."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
