"""Hard-negative mining by segment summary filtering.

Components become integers, floor(256 * x). Every vector is stored with the mean and the
deviation (the length of what is left without the mean) of each of its segments. Over a
segment of L components two vectors' product is L times the product of their means, plus or
minus at most the product of their deviations; summed over the segments that bounds a score
from both sides. Long segments are tried first, their parts next (a segment's summary follows
from those of its parts), and only the pairs that no bound rules out are scored exactly.

Anchors are searched in blocks of ANCHORS against all rows: a block is broadcast (a bounded
size, whatever the table), every task scans its rows once and keeps the best rows of each
search, and the tasks' bests are merged by a window. The first scan finds the positives of a
block, whose scores give the windows of its negatives; a scan of a sixteenth of the rows gives
scores that the sought negatives reach at least, so the scan of all rows returns few more rows
than are wanted; that floor only rules out rows that ten others beat.

Defined results: rows with a NULL label, a NULL or empty vector, or a NULL or non-finite
component take no part. Vectors of different lengths are no candidates for each other. Rows
of the anchor's own id are not its positives; otherwise repeated rows count one by one, and
repeated anchors (same id, label and vector) are one anchor. A NULL id is never an anchor and
comes after the others among ties. Integers are held within plus or minus 2**22, so that
scores fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.common import materialize, offsets_of
from loanmart.llm.subspace import binary_column, binary_rows

#: Components of a stored segment, and of the longer one made of so many parts.
SEGMENT, PARTS = 4, 4
#: Anchors broadcast at once.
ANCHORS = 32_768
#: Anchors and rows compared at once.
TILE_ANCHORS, TILE_ROWS = 1024, 2048
#: One row of so many is scanned first, for the floor; not worth it for fewer tasks than that.
FIRST_SHARE = 16
LIMIT = 1 << 22
NO_ID = np.iinfo(np.int64).max
LEAST, MOST = np.iinfo(np.int64).min // 2, np.iinfo(np.int64).max // 2


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of integer vectors, the last one filled up with zeros."""
    width = -(-q.shape[1] // (SEGMENT * PARTS)) * SEGMENT * PARTS
    x = np.zeros((len(q), width))
    x[:, : q.shape[1]] = q
    x = x.reshape(len(q), -1, SEGMENT)
    mean = x.mean(axis=2)
    return mean, np.sqrt(((x - mean[:, :, None]) ** 2).sum(axis=2))


def coarser(mean: np.ndarray, deviation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments of PARTS times the length."""
    parts, inner = mean.reshape(len(mean), -1, PARTS), (deviation.reshape(len(mean), -1, PARTS) ** 2).sum(axis=2)
    whole = parts.mean(axis=2)
    return whole, np.sqrt(inner + SEGMENT * ((parts - whole[:, :, None]) ** 2).sum(axis=2))


class Vectors:
    """Rows of one vector length: integers and summaries from long segments to short ones."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, mean: np.ndarray, deviation: np.ndarray):
        self.ids, self.labels, self.q = ids, labels, q
        mean, deviation = mean.astype(np.float64), deviation.astype(np.float64)
        self.levels = [(SEGMENT * PARTS, *coarser(mean, deviation)), (SEGMENT, mean, deviation)]
        self.norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.ids)

    def pick(self, at: np.ndarray) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.q, out.norm = self.ids[at], self.labels[at], self.q[at], self.norm[at]
        out.levels = [(n, m[at], d[at]) for n, m, d in self.levels]
        return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    top = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if top < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def possible(a: Vectors, r: Vectors, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs among ``alive`` that the bounds leave within [low, high]."""
    rows, cols = np.arange(len(a)), np.arange(len(r))
    for level in range(len(a.levels)):
        keep_r, keep_c = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(keep_r):
            return (np.zeros(0, np.int64),) * 3
        a, r, alive, low, high = a.pick(keep_r), r.pick(keep_c), alive[np.ix_(keep_r, keep_c)], low[keep_r], high[keep_r]
        rows, cols = rows[keep_r], cols[keep_c]
        (length, ma, da), (_, mr, dr) = a.levels[level], r.levels[level]
        middle = length * (ma @ mr.T)
        # stored summaries are single precision
        reach = da @ dr.T + 1e-6 * a.norm[:, None] * r.norm[None, :] + 1
        alive &= (middle + reach >= low[:, None]) & (middle - reach <= high[:, None])
    i, j = np.nonzero(alive)
    if len(i) * 16 < alive.size and np.abs(a.q).max(initial=0) < 2**20 > np.abs(r.q).max(initial=0):
        score = np.concatenate([np.zeros(0, np.int64), *(np.einsum("ij,ij->i", a.q[i[k : k + 65536]].astype(np.int64), r.q[j[k : k + 65536]].astype(np.int64)) for k in range(0, len(i), 65536))])
    else:
        score = products(a.q, r.q)[i, j]
    return rows[i], cols[j], score


class Search:
    """The best ``most`` rows of each search: anchors with one or more score windows each."""

    def __init__(self, anchors: Vectors, low: np.ndarray, high: np.ndarray, most: int, same_label: bool):
        self.anchors, self.low, self.high, self.most, self.same_label = anchors, low.copy(), high, most, same_label
        self.score = np.full((low.size, most), LEAST)
        self.id = np.full((low.size, most), NO_ID)
        self.filled = np.zeros(low.size, np.int64)

    def offer(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(window)
        old_w, old_k = np.nonzero(np.arange(self.most)[None, :] < self.filled[touched][:, None])
        old_w = touched[old_w]
        window = np.concatenate([old_w, window])
        score, ids = np.concatenate([self.score[old_w, old_k], score]), np.concatenate([self.id[old_w, old_k], ids])
        order = np.lexsort((ids, -score, window))
        window, score, ids = window[order], score[order], ids[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        best = rank < self.most
        window, rank = window[best], rank[best]
        self.score[window, rank], self.id[window, rank] = score[best], ids[best]
        self.filled[touched] = np.bincount(np.searchsorted(touched, window), minlength=len(touched))
        full = touched[self.filled[touched] == self.most]
        self.low.ravel()[full] = np.maximum(self.low.ravel()[full], self.score[full, -1])

    def take(self, rows: Vectors) -> None:
        if self.same_label:
            for label in np.intersect1d(self.anchors.labels, rows.labels).tolist():
                self._tiles(np.flatnonzero(self.anchors.labels == label), rows.pick(np.flatnonzero(rows.labels == label)))
        else:
            self._tiles(np.flatnonzero((self.low <= self.high).any(axis=1)), rows)

    def _tiles(self, wanted: np.ndarray, rows: Vectors) -> None:
        for m in range(0, len(rows), TILE_ROWS):
            part = rows.pick(np.arange(m, min(len(rows), m + TILE_ROWS)))
            for k in range(0, len(wanted), TILE_ANCHORS):
                self._tile(wanted[k : k + TILE_ANCHORS], part)

    def _tile(self, at: np.ndarray, rows: Vectors) -> None:
        a = self.anchors.pick(at)
        open_ = self.low[at] <= self.high[at]
        low, high = np.where(open_, self.low[at], MOST).min(axis=1), np.where(open_, self.high[at], LEAST).max(axis=1)
        if self.same_label:
            alive = a.ids[:, None] != rows.ids[None, :]
        else:
            alive = a.labels[:, None] != rows.labels[None, :]
        i, j, score = possible(a, rows, alive, low, high)
        n = self.low.shape[1]
        for p in range(n):
            hit = np.flatnonzero((score >= self.low[at, p][i]) & (score <= self.high[at, p][i]))
            if len(hit):
                self.offer(at[i[hit]] * n + p, score[hit], rows.ids[j[hit]])

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, k = np.nonzero(np.arange(self.most)[None, :] < self.filled[:, None])
        return w, self.score[w, k], self.id[w, k]


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
STORED = "vec_id long, label long, q binary, mean binary, deviation binary"


def stored(vectors: DataFrame) -> DataFrame:
    """The rows that take part, as integers and segment summaries."""
    number = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) <= 1.7976931348623157e308))
    rows = vectors.where(F.col("label").isNotNull() & F.coalesce(number & (F.size("embedding") > 0), F.lit(False)))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            lengths = np.diff(np.asarray(column.offsets))
            flat, starts = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), offsets_of(lengths)
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                with np.errstate(over="ignore"):
                    q = np.clip(np.floor(256 * flat[starts[at][:, None] + np.arange(dims)]), -LIMIT, LIMIT).astype(np.int32)
                parts = [binary_column(m) for m in (q, *(s.astype(np.float32) for s in summaries(q)))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at)) for c in ("vec_id", "label")), *parts], ["vec_id", "label", "q", "mean", "deviation"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding").mapInArrow(run, STORED)


def by_length(table) -> dict[int, Vectors]:
    """The rows of a batch or table of stored vectors, by vector length."""
    column = table.column("q")
    lengths = pc.binary_length(column).to_numpy() if isinstance(column, pa.ChunkedArray) else pc.binary_length(column).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(lengths).tolist():
        own = table.take(pa.array(np.flatnonzero(lengths == n)))
        mean, deviation = (binary_rows(own.column(c)).view(np.float32) for c in ("mean", "deviation"))
        ids = own.column("vec_id").fill_null(int(NO_ID))
        out[n // 4] = Vectors(np.asarray(ids), np.asarray(own.column("label")), binary_rows(own.column("q")).view(np.int32), mean, deviation)
    return out


def search(rows: DataFrame, searches, most: int) -> DataFrame:
    """(length, search, rank, score, id): the best rows of every search, over all rows.

    ``searches``: broadcast of (anchors, low, high, same label) by vector length.
    """
    names = ["length", "search", "score", "id"]

    def run(batches):
        now: dict[int, Search] = {}
        for batch in batches:
            for n, part in by_length(batch).items():
                if n in searches.value:
                    anchors, low, high, same = searches.value[n]
                    now.setdefault(n, Search(anchors, low, high, most, same)).take(part)
        for n, one in now.items():
            w, score, ids = one.best()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), n, np.int32)), pa.array(w), pa.array(score), pa.array(ids)], names)

    merged = rows.mapInArrow(run, "length int, search long, score long, id long")
    order = Window.partitionBy("length", "search").orderBy(F.desc("score"), "id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mined_block(table: DataFrame, first: DataFrame | None, anchors: dict[int, Vectors], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Hard negatives of one block of anchors, written."""
    sc = table.sparkSession.sparkContext

    def running(searches, most, rows, finish=lambda df: df):
        shared = sc.broadcast(searches)
        out = materialize(finish(search(rows, shared, most)), "mined")
        shared.unpersist()  # the result is written
        return out

    whole = {n: (a, np.full((len(a), 1), LEAST), np.full((len(a), 1), MOST), True) for n, a in anchors.items()}
    found = running(whole, positives, table).select("length", "search", "rank", "score", "id").toArrow()
    length, at, rank, score, ids = (found.column(c).to_numpy() for c in found.column_names)
    windows, named = {}, {}
    for n, a in anchors.items():
        own = length == n
        scores, partners = np.zeros((len(a), positives), np.int64), np.full((len(a), positives), NO_ID)
        lows, highs = np.full((len(a), positives), MOST), np.full((len(a), positives), LEAST)
        place = at[own], rank[own] - 1
        scores[place], partners[place] = score[own], ids[own]
        lows[place], highs[place] = -(-low * score[own] // 100), high * score[own] // 100
        windows[n], named[n] = (a, lows, highs, False), (a.ids, partners, scores)
    if first is not None:
        floor = running(windows, negatives, first).where(F.col("rank") == negatives).select("length", "search", "score").toArrow()
        length, at, score = (floor.column(c).to_numpy() for c in floor.column_names)
        for n, (_, lows, _, _) in windows.items():
            own = length == n
            lows.ravel()[at[own]] = np.maximum(lows.ravel()[at[own]], score[own])
    shared, names = sc.broadcast(named), ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def name(batches):
        for batch in batches:
            length, at = (batch.column(c).to_numpy() for c in ("length", "search"))
            for n in np.unique(length).tolist():
                own, (ids, partners, scores) = np.flatnonzero(length == n), shared.value[n]
                anchor, partner = ids[at[own] // positives], partners.ravel()[at[own]]
                negative = batch.column("id").to_numpy()[own]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(partner, mask=partner == NO_ID), batch.column("rank").take(pa.array(own)), pa.array(negative, mask=negative == NO_ID),
                                                  pa.array(scores.ravel()[at[own]]), batch.column("score").take(pa.array(own))], names)

    out = running(windows, negatives, table, lambda df: df.mapInArrow(name, MINED))
    shared.unpersist()
    return out


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchors_at_once: int = ANCHORS, first_share: int = FIRST_SHARE) -> DataFrame:
    """For each anchor and positive, the first negatives whose score is ``low`` to ``high`` per
    cent of the positive's. ``vectors``: vec_id, embedding, label.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    table = materialize(stored(vectors), "mining-vectors")
    picked = materialize(table.where(F.col("vec_id") % anchor_every == 0).distinct(), "mining-anchors")
    blocks = -(-picked.count() // anchors_at_once)
    tasks = table.rdd.getNumPartitions()
    first = None
    if tasks > first_share:
        share = F.pmod(F.xxhash64("vec_id", "q"), F.lit(first_share)) == 0
        first = materialize(table.where(share).repartition(-(-tasks // first_share)), "mining-first")
    out = vectors.sparkSession.createDataFrame([], MINED)
    for k in range(blocks):
        block = picked.where(F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)) == k).orderBy("vec_id", "label", "q")
        out = out.unionByName(mined_block(table, first, by_length(block.toArrow()), positives, negatives, low, high))
    return out
