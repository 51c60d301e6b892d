"""Document fingerprints by content-defined chunking.

A gear hash of the last bytes runs over the UTF-8 text; a chunk ends where some of its bits
are zero, with a stricter mask before the normal size and a looser one after it
(normalised chunking), between a least and a greatest size. Boundaries depend on nearby
bytes only, so text that moves keeps its chunks. The fingerprint is the set of chunk digests
with chunk lengths; two fingerprints are compared by the shared length over the smaller
total length (containment).

Defined results: NULL and empty texts have the empty fingerprint; two empty fingerprints have
likeness 1, an empty and another one 0. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from loanmart.llm.common import offsets_of, schema_with, shuffle_partitions, span_hashes, text_blocks

#: Chunk sizes in bytes: least, normal, greatest.
LEAST, NORMAL, MOST = 12, 28, 112
#: Bits of the gear hash that must be zero before and after the normal size; bit 11 and those
#: below it depend on the last 12 bytes, the least chunk.
STRICT, LOOSE = np.uint16(0b111110000000), np.uint16(0b111000000000)
GEAR = np.random.default_rng(16).integers(0, 1 << 16, 256).astype(np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """16-bit gear hash of the 16 bytes up to each position, by doubling the width."""
    h = GEAR[data]
    width = 1
    while width < 16:
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
        width *= 2
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of every row (the last one ends the row), and chunks per row.

    A cut is only sought LEAST bytes (a full window) past a chunk's start, so what stands
    before a row in ``data`` has no effect on it.
    """
    h = gear_hashes(data)
    cuts = np.flatnonzero((h & LOOSE) == 0)
    strict = ((h[cuts] & STRICT) == 0).tolist()
    after = (cuts + 1).tolist()
    at, total = 0, len(after)
    ends, counts = [], []
    bounds = offsets.tolist()
    for pos, stop in zip(bounds[:-1], bounds[1:]):
        n = len(ends)
        while stop - pos > LEAST:
            low, middle, high = pos + LEAST, pos + NORMAL, min(pos + MOST, stop)
            while at < total and after[at] < low:
                at += 1
            k = at
            while k < total and after[k] < middle and not strict[k]:
                k += 1
            pos = after[k] if k < total and after[k] < high else high
            ends.append(pos)
        if pos < stop:
            ends.append(stop)
        counts.append(len(ends) - n)
    return np.array(ends, np.int64), np.array(counts, np.int64)


class Prints:
    """Fingerprints of some rows: per row the distinct (digest, length), ascending."""

    def __init__(self, column: pa.Array):
        keys, counts = [np.zeros(0, np.uint64)], []
        for _, _, data, offsets in text_blocks(column):
            ends, per_row = chunk_ends(data, offsets)
            row = np.repeat(np.arange(len(per_row)), per_row)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            # 32 bits of digest, then the length
            key = (span_hashes(data, starts, ends) >> np.uint64(32) << np.uint64(8)) | (ends - starts).astype(np.uint64)
            order = np.lexsort((key, row))
            key, row = key[order], row[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            keys.append(key[first])
            counts.append(np.bincount(row[first], minlength=len(per_row)))
        self.keys = np.concatenate(keys)
        self.offsets = offsets_of(np.concatenate(counts)) if counts else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, i: int) -> np.ndarray:
        return self.keys[self.offsets[i] : self.offsets[i + 1]]

    def text(self, i: int) -> str:
        """10 hex digits for each chunk: 8 of its digest, 2 of its length."""
        return self.keys[self.offsets[i] : self.offsets[i + 1]].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Length of the shared chunks over the smaller total length."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    size = lambda k: int((k & np.uint64(0xFF)).sum())
    return size(np.intersect1d(a, b, assume_unique=True)) / min(size(a), size(b))


def parse_fingerprint(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 3:] = raw
    return wide.view(">u8").astype(np.uint64).ravel()


def fingerprint(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the fingerprint of every row."""
    picked = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        for batch in batches:
            for lo, hi, _, _ in text_blocks(batch.column("_text")):
                prints = Prints(batch.column("_text").slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array([prints.text(i) for i in range(len(prints))], pa.string())], [*keep, "fingerprint"])

    return picked.mapInArrow(run, schema_with(picked.drop("_text"), "fingerprint string"))


# ------------------------------------------------- each document and the one after it


def _at_or_below(value, borders: list):
    """How many of the ascending borders are at or below the value, by bisection."""
    array = F.array(*map(F.lit, borders))

    def halve(a, _):
        middle = F.shiftright(a["lo"] + a["hi"], 1)
        below = F.element_at(array, middle + 1) <= value
        moved = F.struct(F.when(below, middle + 1).otherwise(a["lo"]).alias("lo"), F.when(below, a["hi"]).otherwise(middle).alias("hi"))
        return F.when(a["lo"] < a["hi"], moved).otherwise(a)

    whole = F.struct(F.lit(0).alias("lo"), F.lit(len(borders)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(borders).bit_length() + 1)), whole, halve, lambda a: a["lo"])


def with_successor_runs(docs: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents dealt into runs of ascending ids; each run also holds the next run's first row.

    Columns: run, guest (the row belongs to a later run), place (0; 1 for the row that
    follows the last one), order, text. One shuffle carries the texts; the borders are as
    many ids as there are partitions. Ties in the id go by text; NULL ids come first.
    """
    spark = docs.sparkSession
    n = max(2, shuffle_partitions(spark))
    rows = docs.select(F.col(order).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    borders = rows.agg(F.percentile_approx("_id", [k / n for k in range(1, n)], 10000)).first()[0] or []
    borders = sorted(set(borders))
    run = _at_or_below(F.col("_id"), borders) if borders else F.lit(0)
    rows = rows.withColumn("run", F.when(F.col("_id").isNull(), 0).otherwise(run))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    firsts = {r["run"]: r["first"] for r in rows.groupBy("run").agg(F.min(F.struct("_id", "_tie")).alias("first")).collect()}
    runs = sorted(firsts)
    # the first row of each run also goes to the run before it; met by a join, so the plan does not grow with the runs
    before = [(runs[k - 1], r, firsts[r]["_id"], firsts[r]["_tie"]) for k, r in enumerate(runs)]
    before = spark.createDataFrame(before, StructType([StructField("_before", IntegerType()), StructField("_run", IntegerType()), StructField("_first", rows.schema["_id"].dataType), StructField("_first_tie", LongType())]))
    is_first = (F.col("run") == F.col("_run")) & F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_tie") == F.col("_first_tie"))
    homes = F.array(F.struct(F.col("run").alias("run"), F.lit(False).alias("guest"), F.lit(0).alias("place")))
    guest = F.array(F.struct(F.col("_before").alias("run"), F.lit(True).alias("guest"), F.lit(1).alias("place")))
    out = F.when(F.col("_before").isNull(), homes).otherwise(F.concat(homes, guest))
    rows = rows.join(F.broadcast(before), is_first, "left")
    return rows.select("_id", "_text", "_tie", F.explode(out).alias("_at")).select("_at.run", "_at.guest", "_at.place", "_id", "_tie", "_text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likenesses.

    The edited text has the last floor(n/2) code points replaced by as many from the start of
    the next document (the first one after the last).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = with_successor_runs(docs)
    n = max(2, shuffle_partitions(docs.sparkSession))
    dealt = dealt.repartition(n, "run").sortWithinPartitions("run", "place", "_id", "_tie")
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [c.split()[0] for c in schema.split(", ")]

    def emit(ids, texts):
        """Rows of all but the last text."""
        own = Prints(pa.array(texts, pa.large_string()))
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, texts[1:])]
        other = Prints(pa.array(edited, pa.large_string()))
        k = range(len(edited))
        cols = [ids, [len(t) for t in texts[:-1]], [hashlib.sha256(e.encode()).hexdigest() for e in edited], [own.text(i) for i in k], [other.text(i) for i in k],
                [likeness(own.row(i), other.row(i)) for i in k], [likeness(own.row(i), own.row(i + 1)) for i in k]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, (id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())))], names)

    id_type = None

    def run(batches):
        nonlocal id_type
        run_now, ids, texts, size, done = None, [], [], 0, False
        for batch in batches:
            id_type = batch.schema.field("_id").type
            for run, guest, i, text in zip(*(batch.column(c).to_pylist() for c in ("run", "guest", "_id", "_text"))):
                if run != run_now:
                    run_now, ids, texts, size, done = run, [], [], 0, False
                if done:  # a repeated first row of the next run
                    continue
                texts.append(text)
                size += len(text)
                if guest:
                    if ids:
                        yield emit(ids, texts)
                    done = True
                    continue
                ids.append(i)
                if size > 2 << 20 and len(texts) > 1:
                    yield emit(ids[:-1], texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return dealt.mapInArrow(run, schema)
