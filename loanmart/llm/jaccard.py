"""Exact Jaccard join of word n-gram sets, as a join of metric space regions.

Jaccard distance is a metric, and most texts are at distance 1 from each other, so regions are
made in two levels.

1. Pivots of the first level are single shingles. A set's home is the region of its first
   shingle in a common order (frequent shingles last, then by hash); its window are
   the regions of the first floor(n / 4) + 1 shingles: of two sets within distance 1/4, each
   has at most a quarter of its shingles outside the other, so their first common shingle lies
   in both windows. Boundary sets are replicated to all regions of their window.
2. Inside a region the member with the smallest key is the pivot. Members linked to a pivot are
   in its component; star links from all regions give components.
3. A region whose members all are of one component is done. In the others, members of different
   components meet: the region splits into Voronoi cells of pivots in Hamming space (parity
   bitmaps, whose distance is at most the size of the sets' symmetric difference), sets within
   the triangle inequality's window of a cell's border are replicated into it, and cells split
   again until they are small. Pairs that the bitmaps don't rule out are compared exactly: those
   of small regions all at once; of large ones first only as many as could join a region's
   components, round after round while that links enough of them, then all that are still apart.
   Rounds only take along the regions that still have several components.

Equal sets are one class from the start, so copies are never compared. Every set pair at or
over the threshold is linked or in one component already; nothing is capped or sampled.
Regions of many members are dealt out in pairs of blocks, so no task holds a whole one.

Classes are named by a 64-bit hash of the set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import LOWER, NOT_SPACE, materialize, mix, run_hashes, schema_with, span_hashes, text_blocks, word_spans

WIDTH = 5
#: Shingles that several sets of a shard share are counted, and the most frequent ones are sorted
#: last. The table only fixes an order, and any order gives the same links: its bound drops nothing.
COMMON_LEAST, COMMON_MOST = 8, 1_000_000
#: Members of a region that one task compares; larger regions are dealt out in pairs of blocks.
BLOCK_MEMBERS = 2048
#: Regions of at most so many members give their pairs at once, without bitmaps.
SMALL_REGION = 32
#: Cells of at most so many members are compared directly; pivots of a larger one.
LEAF, PIVOTS = 64, 8
#: Rounds that compare few pairs end when fewer than one pair in so many is linked; the rest is then
#: compared in full, so this only says when that is done.
ROUND_MISSES = 4
#: Bits of the filter that says which sets a comparison needs.
FILTER_BITS = 1 << 22
SHARD_BYTES = 4 << 20


def owners_sorted(order: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """``order`` sorted by owner; entries of one owner keep their turn."""
    own = owner[order]
    if len(own) and own.max() < 1 << 16:
        own = own.astype(np.uint16)  # sorted by digits
    return order[np.argsort(own, kind="stable")]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, one row after the other, and the row of each.

    A row of fewer words than ``width`` has its whole sequence as its one shingle; one without
    words has none.
    """
    low = LOWER[data]
    starts, ends, row = word_spans(low, offsets, NOT_SPACE)
    words = span_hashes(low, starts, ends)
    n = len(offsets) - 1
    per_row = np.bincount(row, minlength=n)
    runs = run_hashes(words, width)
    whole = row[: len(runs)] == row[width - 1 :] if len(runs) else np.zeros(0, bool)
    hashes, owner = [runs[whole]], [row[: len(runs)][whole]]
    first = np.cumsum(per_row) - per_row
    for size in range(1, width):
        at = np.flatnonzero(per_row == size)
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(31) + words[first[at] + k])
        hashes.append(h)
        owner.append(at)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = owners_sorted(np.argsort(hashes), owner)
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def set_keys(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """64-bit key of each row's set (0 for an empty one)."""
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        if len(hashes):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            total[owner[begin]] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5)), begin)
        sizes = np.bincount(owner, minlength=n).astype(np.uint64)
        keys = mix(total + mix(sizes))
    keys[sizes == 0] = 0
    return keys


def parity_bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the number of shingles at each of m places, m the power of two at or over twice their number."""
    m = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits((np.bincount((hashes & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1).astype(np.uint8)).tobytes()


def _shards(batches, column: str, width: int):
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(column), SHARD_BYTES):
            hashes, owner = shingle_sets(data, offsets, width)
            yield batch, lo, hi, hashes, owner, np.searchsorted(owner, np.arange(hi - lo + 1)), set_keys(hashes, owner, hi - lo)


def profiles(docs: DataFrame, keep: tuple[str, ...], width: int = WIDTH) -> DataFrame:
    """``keep`` columns, n_shingles, key and bitmap (NULL for an empty set) of every row."""
    picked = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches):
        for batch, lo, hi, hashes, _, cut, keys in _shards(batches, "_text", width):
            bitmaps = [parity_bitmap(hashes[a:b]) if b > a else None for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array(np.diff(cut), pa.int64()), pa.array(keys.view(np.int64), pa.int64()), pa.array(bitmaps, pa.binary())], [*keep, "n_shingles", "key", "bitmap"])

    return picked.mapInArrow(run, schema_with(picked.drop("_text"), "n_shingles long, key long, bitmap binary"))


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and their counts in shards that hold them more than once."""

    def run(batches):
        for _, lo, hi, hashes, owner, _, keys in _shards(batches, "text", width):
            _, first = np.unique(keys, return_index=True)  # copies inside a shard count once
            once = np.zeros(hi - lo, bool)
            once[first] = True
            value, n = np.unique(hashes[once[owner]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value[n > 1].view(np.int64), pa.int64()), pa.array(n[n > 1], pa.int64())], ["s", "n"])

    counts = docs.select("text").mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= COMMON_LEAST).orderBy(F.desc("n"), "s").limit(COMMON_MOST).toPandas()
    value = rows["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    return value[order], rows["n"].to_numpy(np.int64)[order]


def memberships(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(shingle, key, n, place, pivot, pivot_n): members of all regions of two sets or more."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs, width))

    def windows(batches):
        value, count = common.value
        for _, lo, hi, hashes, owner, cut, keys in _shards(batches, "text", width):
            _, first = np.unique(keys, return_index=True)  # copies inside a shard go once
            rank = np.zeros(len(hashes), np.int64)
            if len(value):
                at = np.minimum(np.searchsorted(value, hashes), len(value) - 1)
                rank = np.where(value[at] == hashes, count[at], 0)
            order = owners_sorted(np.argsort(rank, kind="stable"), owner)  # hashes ascend already
            sizes = np.diff(cut)
            place = np.arange(len(hashes)) - cut[owner]  # after sorting; owners stay in place
            once = np.zeros(hi - lo, bool)
            once[first] = True
            used = once[owner] & (place <= sizes[owner] // 4)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[order][used].view(np.int64), pa.int64()), pa.array(keys[owner][used].view(np.int64), pa.int64()), pa.array(sizes[owner][used], pa.int32()), pa.array(place[used], pa.int32())], ["shingle", "key", "n", "place"])

    def regions(batches):
        """Rows come sorted by shingle and key; a region's first key is its pivot."""
        shingle = pivot = last = None
        pivot_row = None  # not given out until a second member comes
        for batch in batches:
            s, k, n, p = (batch.column(c).to_numpy() for c in ("shingle", "key", "n", "place"))
            if not len(s):
                continue
            begins = np.ones(len(s), bool)
            begins[1:] = s[1:] != s[:-1]
            again = np.zeros(len(s), bool)  # the same set from another shard
            again[1:] = ~begins[1:] & (k[1:] == k[:-1])
            goes_on = shingle is not None and s[0] == shingle
            if goes_on:
                begins[0] = False
                again[0] = k[0] == last
            group = np.cumsum(begins) - (0 if goes_on else 1)
            # facts of each group's pivot
            first = np.flatnonzero(begins)
            pk, pn = k[first], n[first]
            if goes_on:
                pk, pn = np.concatenate([[pivot], pk]), np.concatenate([[pivot_row[1] if pivot_row else pivot_n], pn])
            fresh = ~again
            members = np.bincount(group[fresh], minlength=len(pk))
            several = members > 1
            if goes_on:
                several[0] = members[0] > 0 or pivot_row is None
            keep = fresh & several[group]
            out = [s[keep], k[keep], n[keep], p[keep], pk[group][keep], pn[group][keep]]
            if goes_on and pivot_row is not None and several[0]:  # the waiting pivot of the last batch
                out = [np.concatenate([[x], y]) for x, y in zip((shingle, *pivot_row, pivot, pivot_row[1]), out)]
                pivot_row = None
            tail = len(pk) - 1
            if not (goes_on and tail == 0):
                pivot_row = None if several[tail] else (int(pk[tail]), int(pn[tail]), int(p[first[-1]]))
            shingle, pivot, pivot_n, last = s[-1], pk[tail], pn[tail], k[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()))], ["shingle", "key", "n", "place", "pivot", "pivot_n"])

    posted = docs.select("text").mapInArrow(windows, "shingle long, key long, n int, place int")
    return posted.repartition("shingle").sortWithinPartitions("shingle", "key").mapInArrow(regions, "shingle long, key long, n int, place int, pivot long, pivot_n int")


# ---------------------------------------------------------------- comparisons


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int32)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps folded to ``words`` 64-bit words; distances can only shrink."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def near_pairs(bits: np.ndarray, size: np.ndarray, allowed, index: np.ndarray) -> list[np.ndarray]:
    """Pairs of ``index`` that the bitmaps don't rule out, by Voronoi cells of pivots.

    Linked sets differ in at most (a + b) / 7 shingles, so in at most that many bits.
    """
    n = len(index)
    if n < 2:
        return []
    if n <= LEAF:
        d = _hamming(bits[index], bits[index])
        i, j = np.nonzero(np.triu(7 * d <= size[index][:, None] + size[index][None, :], 1))
        a, b = index[i], index[j]
        ok = allowed(a, b)
        return [np.stack([a[ok], b[ok]], axis=1)]
    reach = 2 * int(size[index].max()) // 7
    pivots = index[np.linspace(0, n - 1, PIVOTS).astype(np.int64)]
    step = max(LEAF, (1 << 19) // (LEAF * bits.shape[1]))  # bounds the arrays of one comparison
    d = np.concatenate([_hamming(bits[index[k : k + step]], bits[pivots]) for k in range(0, n, step)])
    home = d.argmin(axis=1)
    window = d <= d[np.arange(n), home][:, None] + 2 * reach
    # each pair of cells meets in the earlier cell's region
    cells = [(index[home == c], index[window[:, c] & (home > c)]) for c in range(PIVOTS)]
    if sum((len(own) + len(guests)) ** 2 for own, guests in cells if len(own)) <= n * n / 2:
        return [p for own, guests in cells if len(own) for p in near_pairs(bits, size, allowed, np.concatenate([own, guests]))]
    out = []  # the pivots don't divide these sets: compare them in strips
    for k in range(0, n, LEAF):
        strip, rest = index[k : k + LEAF], index[k:]
        for m in range(0, len(rest), step):
            e = _hamming(bits[strip], bits[rest[m : m + step]])
            i, j = np.nonzero(7 * e <= size[strip][:, None] + size[rest[m : m + step]][None, :])
            a, b = strip[i], rest[m : m + step][j]
            ok = (a != b) & allowed(a, b)
            out.append(np.stack([a[ok], b[ok]], axis=1))
    return out


def spanning(pairs: np.ndarray, distance: np.ndarray, component: np.ndarray) -> np.ndarray:
    """The pairs, nearest first, that join components which earlier ones have not."""
    _, part = np.unique(component, return_inverse=True)
    parent = list(range(int(part.max()) + 1)) if len(part) else []

    def top(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    kept, apart = [], len(parent) - 1
    for i in np.argsort(distance, kind="stable").tolist():
        if not apart:
            break
        a, b = top(part[pairs[i, 0]]), top(part[pairs[i, 1]])
        if a != b:
            parent[a] = b
            kept.append(i)
            apart -= 1
    return pairs[kept]


def region_pairs(key, component, size, place, bitmaps, part, forest: bool) -> np.ndarray:
    """Pairs of members of different components that may be linked, in one region (or block pair).

    Only pairs whose places allow this to be their first common shingle are needed. ``part``:
    0 and 1 are the two blocks of a pair of different blocks, whose pairs within a block are
    compared elsewhere. ``forest``: only pairs that would join all those components.
    """
    words = np.array([len(b) // 8 for b in bitmaps])
    out, distance = [], []

    def allowed(a, b):
        total = size[a] + size[b]
        return ((component[a] != component[b]) & (4 * np.minimum(size[a], size[b]) >= 3 * np.maximum(size[a], size[b]))
                & (7 * (place[a] + place[b]) <= total) & ((part[a] != part[b]) | (part[a] < 0)))

    for w in np.unique(words).tolist():
        # sizes of linked sets differ by a third at most: their bitmaps by one doubling
        index = np.flatnonzero((words == w) | (words == 2 * w))
        if len(np.unique(component[index])) < 2:
            continue
        bits = np.zeros((len(key), w), np.uint64)
        for v in (w, 2 * w):
            at = np.flatnonzero(words == v)
            if len(at):
                bits[at] = _fold(np.frombuffer(b"".join(bitmaps[k] for k in at.tolist()), np.uint64).reshape(len(at), v), w)
        found = near_pairs(bits, size, allowed, index)
        out += found
        distance += [np.bitwise_count(bits[f[:, 0]] ^ bits[f[:, 1]]).sum(axis=1) for f in found]
    pairs = np.concatenate([*out, np.zeros((0, 2), np.int64)])
    if forest and len(pairs):
        pairs = spanning(pairs, np.concatenate(distance), component)
    a, b = key[pairs[:, 0]], key[pairs[:, 1]]
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)


def prune(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) that the bitmaps of both classes don't rule out."""
    left = classes.select(F.col("key").alias("a"), F.col("n_shingles").alias("na"), F.col("bitmap").alias("ba"))
    right = classes.select(F.col("key").alias("b"), F.col("n_shingles").alias("nb"), F.col("bitmap").alias("bb"))

    def run(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            ok = 4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)
            for i in np.flatnonzero(ok).tolist():
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64)[None, :] for c in ("ba", "bb"))
                w = min(x.shape[1], y.shape[1])
                ok[i] = 7 * int(np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum()) <= na[i] + nb[i]
            kept = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return edges.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a long, b long")


def bit_distances(bitmaps: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hamming distances of the bitmaps of rows i and j, the longer one folded to the shorter."""
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    begin, words = offsets[:-1] // 8, np.diff(offsets) // 8
    data = np.frombuffer(bitmaps.buffers()[2], np.uint64, int(offsets[-1]) // 8)
    out = np.zeros(len(i), np.int64)
    least, most = np.minimum(words[i], words[j]), np.maximum(words[i], words[j])
    for w, v in np.unique(np.stack([least, most], axis=1), axis=0).tolist():
        at = np.flatnonzero((least == w) & (most == v))
        for part in np.array_split(at, 1 + len(at) * v // (1 << 20)):  # bounds the arrays of one comparison
            x, y = i[part], j[part]
            x, y = np.where(words[x] == w, x, y), np.where(words[x] == w, y, x)
            short = data[begin[x][:, None] + np.arange(w)]
            out[part] = np.bitwise_count(short ^ _fold(data[begin[y][:, None] + np.arange(v)], w)).sum(axis=1)
    return out


def sketches(batches):
    """(key, sketch): each bitmap folded to the power of two at or over 3/4 of its set's size.

    Distances can only shrink. Of sets with little in common they stay near half the bits, over the
    2/7 of a size that linked ones reach.
    """
    for batch in batches:
        found = []
        for bitmap, n in zip(batch.column("bitmap"), batch.column("n_shingles").to_pylist()):
            bits = np.frombuffer(bitmap.as_buffer(), np.uint64)[None, :]
            found.append(_fold(bits, max(64, 1 << (-(-3 * n // 4) - 1).bit_length()) // 64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], ["key", "sketch"])


def small_region_pairs(batches):
    """Pairs (a, b) of different components that the bitmaps don't rule out, from rows sorted by shingle."""
    names = ("shingle", "key", "component", "n", "place")
    held, held_bits = [np.zeros(0, np.int64)] * len(names), pa.array([], pa.binary())

    def pairs(cols, bitmaps):
        s, key, part, n, place = cols
        found = [np.zeros((0, 2), np.int64)]
        for lag in range(1, SMALL_REGION):
            i, j = np.arange(max(0, len(s) - lag)), np.arange(lag, max(lag, len(s)))
            same = s[i] == s[j]
            if not same.any():
                break
            ok = (same & (part[i] != part[j]) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j])) & (7 * (place[i] + place[j]) <= n[i] + n[j]))
            i, j = i[ok], j[ok]
            near = 7 * bit_distances(bitmaps, i, j) <= n[i] + n[j] if len(i) else np.zeros(0, bool)
            i, j = i[near], j[near]
            less = key[i] < key[j]
            i, j = np.where(less, i, j), np.where(less, j, i)
            found.append(np.stack([key[i], key[j]], axis=1))
        out = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(out[:, k], pa.int64()) for k in range(2)], ["a", "b"])

    for batch in batches:
        cols = [np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, names)]
        bits = pa.concat_arrays([held_bits, batch.column("sketch").cast(pa.binary())])
        if len(cols[0]):
            ends = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield pairs([c[:cut] for c in cols], bits.slice(0, cut))
            held, held_bits = [c[cut:] for c in cols], bits.slice(cut)
    if len(held[0]):
        yield pairs(held, held_bits)


def _filter_places(row: np.ndarray) -> np.ndarray:
    return (mix(row.astype(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(key, shingles) of the wanted classes (key, row): ``row`` names the document to take them from.

    A filter of fixed size tells tasks which documents to cut into shingles; the others' texts are
    not looked at.
    """

    def places(batches):
        for batch in batches:
            at = np.unique(_filter_places(batch.column("row").to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([at.tolist()], pa.list_(pa.int32()))], ["at"])

    def union(batches):
        bits = np.zeros(FILTER_BITS, np.uint8)
        for batch in batches:
            bits[np.asarray(batch.column("at").flatten())] = 1
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    wanted = wanted.select("key", "row")
    got = wanted.mapInArrow(places, "at array<int>").repartition(1).mapInArrow(union, "bits binary").first()
    shared = docs.sparkSession.sparkContext.broadcast(bytes(got["bits"]) if got else bytes(FILTER_BITS // 8))

    def run(batches):
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        chosen = (batch.filter(pa.array(bits[_filter_places(batch.column("row").to_numpy().view(np.uint64))])) for batch in batches)
        for batch, lo, hi, hashes, _, cut, keys in _shards(chosen, "text", width):
            row = batch.column("row").slice(lo, hi - lo).to_numpy().view(np.uint64)
            use = np.flatnonzero(np.diff(cut) > 0)
            lists = [hashes[cut[i] : cut[i + 1]].view(np.int64) for i in use.tolist()]
            flat = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64), pa.int64())
            shingles = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(keys[use].view(np.int64), pa.int64()), pa.array(row[use].view(np.int64), pa.int64()), shingles], ["key", "row", "shingles"])

    found = docs.select("row", "text").mapInArrow(run, "key long, row long, shingles array<long>")
    return found.join(wanted, ["key", "row"], "left_semi").dropDuplicates(["key"]).select("key", "shingles")


def linked(edges: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """Edges (a, b) whose sets have 100 * intersection >= 75 * union, compared exactly."""
    ends = edges.select(F.col("a").alias("key")).unionByName(edges.select(F.col("b").alias("key"))).distinct()
    wanted = materialize(ends.join(classes.select("key", "row"), "key"), "jaccard-wanted")
    sets = materialize(sets_of(docs, wanted, width), "jaccard-sets")
    both = (edges.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("t")).where("100 * i >= 75 * (t - i)").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(key, component): connected components by alternating large and small stars."""
    stars = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    facts = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    now = facts(stars)
    while now[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        stars = materialize(small, "stars")
        before, now = now, facts(stars)
        if now == before:
            break
    return stars.select(F.col("u").alias("key"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct())


def mixed_regions(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the regions of several components, their components and the region's number of members.

    Components only grow, so a region left out here is never needed again; nor is one of two members
    that can't have this as their first common shingle.
    """
    named = members.select("shingle", "key", "n", "place").join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    facts = F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"), F.sum("place").alias("places"), F.sum("n").alias("sizes"), F.min("n").alias("least"), F.max("n").alias("most")
    # two members that cannot be linked here by their sizes or places are left out as well
    mixed = named.groupBy("shingle").agg(*facts).where("lo <> hi and (members > 2 or (4 * least >= 3 * most and 7 * places <= sizes))")
    return named.join(mixed.select("shingle", "members"), "shingle").select("shingle", "key", "n", "place", "component", "members")


def small_pairs(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of different components that meet in a small region of :func:`mixed_regions` and may be linked."""
    rows = mixed.where(F.col("members") <= SMALL_REGION).select("shingle", "key", "component", "n", "place")
    rows = rows.join(classes.select("key", "n_shingles", "bitmap").mapInArrow(sketches, "key long, sketch binary"), "key").select("shingle", "key", "component", "n", "place", "sketch")
    return rows.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(small_region_pairs, "a long, b long").distinct()


def large_pairs(mixed: DataFrame, classes: DataFrame, forest: bool = False) -> DataFrame:
    """The same of the other regions.

    ``forest``: of each region only as many as could join its components.
    """
    chosen = mixed.where(F.col("members") > SMALL_REGION).withColumn("blocks", F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int"))
    # a member of a region of several blocks goes to every pair of blocks that has its own
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (chosen.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("pair", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
             .withColumn("part", F.when(F.floor(F.col("pair") / F.col("blocks")) == F.col("pair") % F.col("blocks"), -1).when(F.col("block") <= F.col("other"), 0).otherwise(1)))
    dealt = dealt.join(classes.select("key", "bitmap"), "key")

    def run(batches):
        names = ("shingle", "pair", "key", "component", "n", "place", "part")
        held: list = []

        def pairs_of(table):
            cols = {c: table.column(c).to_numpy() for c in names}
            bitmaps = table.column("bitmap").to_pylist()
            begins = np.flatnonzero(np.concatenate([[True], (cols["shingle"][1:] != cols["shingle"][:-1]) | (cols["pair"][1:] != cols["pair"][:-1])]))
            found = []
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), table.num_rows]):
                if b - a > 1:
                    found.append(region_pairs(cols["key"][a:b], cols["component"][a:b], cols["n"][a:b].astype(np.int64), cols["place"][a:b].astype(np.int64), bitmaps[a:b], cols["part"][a:b], forest))
            pairs = np.unique(np.concatenate([*found, np.zeros((0, 2), np.int64)]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # the last region of a batch may go on in the next one
            s, p = batch.column("shingle").to_numpy(), batch.column("pair").to_numpy()
            ends = np.flatnonzero((s != s[-1]) | (p != p[-1]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield pairs_of(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and (held[-1].column("shingle")[-1].as_py() != s[0] or held[-1].column("pair")[-1].as_py() != p[0]):
                yield pairs_of(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield pairs_of(pa.Table.from_batches(held))

    dealt = dealt.select("shingle", "pair", "key", "component", "n", "place", "part", "bitmap").repartition("shingle", "pair").sortWithinPartitions("shingle", "pair")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_classes(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): key and n_shingles of every row, and the component of each linked class."""
    docs = docs.select(*keep, "text", F.xxhash64(*keep).alias("row"))
    rows = materialize(profiles(docs, (*keep, "row"), width), "jaccard-profiles")
    # copies may be a third of all rows: grouped with a combine before the shuffle
    classes = materialize(rows.where("n_shingles > 0").groupBy("key").agg(F.min("row").alias("row"), F.max("n_shingles").alias("n_shingles"), F.max("bitmap").alias("bitmap")), "jaccard-classes")
    members = materialize(memberships(docs, width), "jaccard-members")
    stars = members.where("key <> pivot and 4 * least(n, pivot_n) >= 3 * greatest(n, pivot_n)").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    first = materialize(linked(materialize(prune(stars, classes), "jaccard-stars"), docs, classes, width), "jaccard-links")
    labels = components(first)
    mixed = materialize(mixed_regions(members, labels), "jaccard-mixed")
    small = small_pairs(mixed, classes)  # compared in full at once, so later rounds have the large regions only
    large = mixed.where(F.col("members") > SMALL_REGION)
    while True:  # join components of large regions by few pairs, as long as that finds enough links
        few = large_pairs(large, classes, True)
        pairs = materialize(few if small is None else few.unionByName(small).distinct(), "jaccard-pairs")
        new = materialize(linked(pairs, docs, classes, width), "jaccard-links")
        n_pairs, n_new = pairs.count(), new.count()
        if n_new:
            labels = materialize(_joined(labels, new), "jaccard-labels")
            large = materialize(mixed_regions(large, labels), "jaccard-mixed")
        if n_new * ROUND_MISSES < n_pairs or not n_new:
            break
        small = None
    # what is left apart is compared in full
    last = linked(materialize(large_pairs(large, classes), "jaccard-pairs"), docs, classes, width)
    return rows, _joined(labels, last)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: those of the old ones' edges and the new."""
    return components(labels.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(links.select("a", "b")))


def jaccard_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    component_id is the smallest doc_id that links reach. NULL and empty texts link with
    nothing: their component is their own id. Rows of one id with different texts are separate
    rows; rows with a NULL id take the smallest id of their component, or NULL.
    """
    rows, labels = near_classes(docs.select("doc_id", "text"), ("doc_id",), width)
    least = rows.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    wide = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.select("key", "component").join(wide, "component").select("key", "component_id")
    out = rows.select("doc_id", "n_shingles", "key").join(of_class, "key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of each component: the smallest id (then text); those without words all stay.

    Of rows that repeat the kept id and text (or its text without an id) the one with the
    smallest other columns stays.
    """
    ids = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    rows, labels = near_classes(ids, ("doc_id", "tie"), width)
    own = rows.where("n_shingles > 0").join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    first = own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")).alias("first"))
    kept = first.select("first.doc_id", "first.tie")
    pairs = own.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n"))
    marks = pairs.join(kept.withColumn("kept", F.lit(True)).distinct(), (pairs["doc_id"].eqNullSafe(kept["doc_id"])) & (pairs["tie"] == kept["tie"]), "left").where("kept is null or n > 1").select(pairs["doc_id"].alias("_id"), pairs["tie"].alias("_tie"), F.col("kept").isNotNull().alias("_repeats"))
    marks = materialize(marks, "jaccard-gone")
    same = docs["doc_id"].eqNullSafe(marks["_id"]) & (F.xxhash64(docs["text"]) == marks["_tie"])
    left = docs.join(marks, same, "left_anti")
    # repeats of a kept row, combined before the shuffle
    repeats = docs.join(marks.where("_repeats"), same, "left_semi")
    one = repeats.groupBy("doc_id", F.xxhash64("text").alias("_tie")).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return left.unionByName(one.select("_row.*"))
