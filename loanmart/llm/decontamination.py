"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of documents inside a task. Its words become symbols of the test phrases'
alphabet; maximal runs of words that occur in some phrase and are long enough to hold one are
kept (no phrase can occur elsewhere), each closed by a border. Over that text the shard's
suffix array is built by prefix doubling, its Burrows-Wheeler transform goes into a wavelet
matrix, and all phrases are searched backwards together, word by word, by rank queries.
Occurrences are located by walking to sampled suffix positions, and the hit word ranges of a
document are merged into removal spans.

Phrases: every window of ``width`` words of an item, or the whole item if it is shorter. They
go to the tasks in blocks of about ``PHRASE_WORDS`` item words; a task holds one block at a time
and searches each shard for every block, so memory is bounded whatever the size of the benchmark.

Defined results: a NULL or empty text has no words and no hits; items without words (or NULL
texts) hit nothing; an item without an id hits words like any other but is in no list of items;
repeated items of one id count once; several rows of one document id are
separate rows. Spans are in bytes of the UTF-8 text, ascending and disjoint.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import ALNUM, LOWER, materialize, offsets_of, schema_with, segment_arange, span_hashes, text_blocks, word_spans

WIDTH = 10
#: Words of benchmark items whose phrases are broadcast together.
PHRASE_WORDS = 200_000
#: Every so many-th text position of the index is sampled.
SAMPLE = 16
#: Text bytes of one shard.
SHARD_BYTES = 4 << 20


class WaveletMatrix:
    """rank(symbol, i): how often the symbol stands in the first i places, for arrays of queries."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        level = symbols
        for b in range(bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            zero = bit == 0
            self.zeros.append(int(zero.sum()))
            level = np.concatenate([level[zero], level[~zero]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at.copy()
        for k in range(self.bits):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            ones, zeros = self.ones[k], self.zeros[k]
            l1, h1 = ones[low], ones[high]
            low = np.where(bit, zeros + l1, low - l1)
            high = np.where(bit, zeros + h1, high - h1)
        return high - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; only tied suffixes are ranked again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    key = symbols[order]
    rank[order] = np.searchsorted(key, key)  # rank: first place of the equal ones
    step = 1
    while True:
        place = rank[order]
        tied = np.zeros(n, bool)
        same = place[1:] == place[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        where = np.flatnonzero(tied)
        if not len(where):
            return order
        at = order[where]
        after = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        inner = np.lexsort((after, rank[at]))
        at, after = at[inner], after[inner]
        order[where] = at
        own = rank[at]
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        start = np.maximum.accumulate(np.where(new, where, 0))
        rank[at] = start
        step *= 2


class FMIndex:
    """Index of runs of symbols (1..top), each closed by a border of its own."""

    def __init__(self, runs: np.ndarray, lengths: np.ndarray, top: int):
        n_runs = len(lengths)
        n = len(runs) + n_runs
        begin = offsets_of(lengths + 1)[:-1]
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[begin + lengths] = False
        text[inside] = runs
        # borders sort before all symbols and among themselves by place, so no two suffixes tie beyond one
        ordered = text + n_runs
        ordered[~inside] = np.arange(n_runs)
        order = suffix_array(ordered)
        before = text[order - 1]  # of the first suffix: the last border
        self.n, self.top = n, top
        self.matrix = WaveletMatrix(before, max(1, int(top).bit_length()))
        self.first = offsets_of(np.bincount(text, minlength=top + 2))  # places of suffixes by first symbol
        self.before = before
        head = np.zeros(n, bool)
        head[begin] = True
        sampled = (order % SAMPLE == 0) | head[order]  # a walk ends before it meets a border
        self.sampled = sampled
        self.sample_at = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the phrases (rows of symbols, 0: not in use, at the left)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for k in range(phrases.shape[1] - 1, -1, -1):
            go = np.flatnonzero((phrases[:, k] > 0) & (low < high))
            c = phrases[go, k]
            both = self.matrix.rank(np.concatenate([c, c]), np.concatenate([low[go], high[go]]))
            low[go] = self.first[c] + both[: len(go)]
            high[go] = self.first[c] + both[len(go) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        rows = rows.astype(np.int64)
        steps, out = np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        active = np.arange(len(rows))
        while len(active):
            r = rows[active]
            done = self.sampled[r]
            out[active[done]] = self.samples[self.sample_at[r[done]]] + steps[active[done]]
            active = active[~done]
            r = rows[active]
            c = self.before[r]
            rows[active] = self.first[c] + self.matrix.rank(c, r)
            steps[active] += 1
        return out


class Phrases:
    """Distinct phrases of some items: their symbols, lengths, and the items that hold them."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        """items: (id as text, text) with distinct ids."""
        words, owners = [], []
        for i, (_, raw) in enumerate(items):
            data = LOWER[np.frombuffer(raw, np.uint8)]
            starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
            words.append(span_hashes(data, starts, ends))
            owners.append(np.full(len(starts), i))
        self.ids = np.array([i for i, _ in items], dtype=object)
        self.alphabet = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        rows, holders = [], []
        for i, w in enumerate(words):
            symbols = np.searchsorted(self.alphabet, w) + 1
            if 0 < len(w) < width:
                rows.append(np.concatenate([np.zeros(width - len(w), np.int64), symbols])[None, :])
            elif len(w):
                rows.append(np.lib.stride_tricks.sliding_window_view(symbols, width))
            holders.append(np.full(len(rows[-1]) if len(w) else 0, i))
        every = np.concatenate([*rows, np.zeros((0, width), np.int64)])
        self.symbols, which = np.unique(every, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate([*holders, np.zeros(0, np.int64)])], axis=1), axis=0).astype(np.int64)
        self.holders, self.holder_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.symbols) + 1))
        self.lengths = (self.symbols > 0).sum(axis=1)

    def find(self, data: np.ndarray, offsets: np.ndarray):
        """(words per row, word starts, ends, row of each word, hit words, pairs of row and item) of a shard."""
        low = LOWER[data]
        starts, ends, row = word_spans(low, offsets, ALNUM)
        n_rows = len(offsets) - 1
        per_row = np.bincount(row, minlength=n_rows)
        hit = np.zeros(len(starts) + 1, np.int64)
        nothing = per_row, starts, ends, row, hit[:-1] > 0, np.zeros((0, 2), np.int64)
        if not len(self.symbols) or not len(starts):
            return nothing
        hashes = span_hashes(low, starts, ends)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        known = self.alphabet[at] == hashes
        # maximal runs of known words of one row
        edge = np.ones(len(known) + 1, bool)
        edge[1:-1] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(edge)
        size = np.diff(begin)
        begin = begin[:-1]
        use = known[begin] & (size >= self.lengths.min())
        begin, size = begin[use], size[use]
        if not len(begin):
            return nothing
        word = np.repeat(begin, size) + segment_arange(size)
        index = FMIndex(at[word] + 1, size, len(self.alphabet))
        lo, hi = index.search(self.symbols)
        found = np.flatnonzero(lo < hi)
        count = (hi - lo)[found]
        position = index.locate(np.repeat(lo[found], count) + segment_arange(count))
        phrase = np.repeat(found, count)
        # text positions back to words: each run is followed by one border
        run = np.searchsorted(offsets_of(size + 1), position, "right") - 1
        first = begin[run] + position - offsets_of(size + 1)[run]
        np.add.at(hit, first, 1)
        np.add.at(hit, first + self.lengths[phrase], -1)
        held = self.holder_at[phrase + 1] - self.holder_at[phrase]
        items = self.holders[np.repeat(self.holder_at[phrase], held) + segment_arange(held)]
        pairs = np.unique(np.stack([np.repeat(row[first], held), items], axis=1), axis=0)
        return per_row, starts, ends, row, np.cumsum(hit[:-1]) > 0, pairs


def merged_spans(starts, ends, row, hit, n_rows: int) -> list[list[tuple[int, int]]]:
    """Byte spans (from the shard's first byte) of each row's runs of hit words."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n_rows)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
        for a, b in zip(at[new].tolist(), at[last].tolist()):
            out[row[a]].append((int(starts[a]), int(ends[b])))
    return out


def phrase_blocks(benchmark: DataFrame, width: int, item_id: str, text: str) -> list:
    """Broadcast phrase sets of blocks of items; a block has a bounded number of words (or one item)."""
    spark = benchmark.sparkSession
    size = F.size(F.split(F.lower("_text"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    items = (benchmark.select(F.col(item_id).cast("string").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
             .dropDuplicates(["_id", "_text"]).withColumn("_size", size))
    blocks, block, words = [], {}, 0
    for r in items.orderBy("_id").toLocalIterator():  # one block is in memory at a time
        block.setdefault(r["_id"], []).append(r["_text"])
        words += r["_size"]
        if words >= PHRASE_WORDS:
            blocks.append(spark.sparkContext.broadcast(_phrases(block, width)))
            block, words = {}, 0
    if block or not blocks:
        blocks.append(spark.sparkContext.broadcast(_phrases(block, width)))
    return blocks


def _phrases(block: dict[str, list[str]], width: int) -> Phrases:
    """Phrases of items by id; different texts of one id are searched apart."""
    flat = [(i, t.encode()) for i, texts in block.items() for t in texts]
    return Phrases(flat, width)


def _one_by_one(blocks):
    """Phrase sets in turn; with several, each is let go before the next is loaded."""
    for b in blocks:
        yield b.value
        if len(blocks) > 1:
            b.__dict__.pop("_value", None)


def scan(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", width: int = WIDTH, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, spans (bytes), n_hit and items (ids whose phrases occur) of every row."""
    blocks = phrase_blocks(benchmark, width, item_id, item_text)
    picked = docs.select(*keep, F.col(text).alias("_text"))
    schema = schema_with(picked.drop("_text"), "n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>")
    span_type = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("_text"), SHARD_BYTES):
                n = hi - lo
                hit, pairs = None, []
                for phrases in _one_by_one(blocks):
                    per_row, starts, ends, row, found, held = phrases.find(data, offsets)
                    hit = found if hit is None else hit | found
                    pairs.append((held[:, 0], phrases.ids[held[:, 1]]))
                items = [set() for _ in range(n)]
                for rows, ids in pairs:
                    for r, i in zip(rows.tolist(), ids):
                        if i is not None:
                            items[r].add(i)
                spans = [[{"start": a - int(offsets[k]), "end": b - int(offsets[k])} for a, b in row_spans] for k, row_spans in enumerate(merged_spans(starts, ends, row, hit, n))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, n) for c in keep), pa.array(per_row, pa.int64()), pa.array(np.bincount(row[hit], minlength=n), pa.int64()), pa.array(spans, pa.list_(span_type)), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                                                 [*keep, "n_words", "n_hit", "spans", "items"])

    return picked.mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the items found, contaminated."""
    found = scan(docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def cut(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents without their removal spans (a line break stands for each); those left without words go.

    Columns are those of ``docs``; n_chars, where there is one, counts the new text.
    """
    hashed = F.xxhash64("text")
    found = scan(docs.select("doc_id", hashed.alias("hash"), "text"), benchmark, ("doc_id", "hash"), width=width)
    # of the texts with hits only their spans leave the scan
    marks = found.where("n_hit > 0").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.when(F.col("n_hit") < F.col("n_words"), F.col("spans")).alias("_spans")).dropDuplicates(["_id", "_hash"])
    marks = materialize(marks, "decontamination-spans")
    met = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), hashed.alias("own_hash")).join(marks, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_hash") == F.col("_hash")), "left")
    own = F.col("row")["text"]
    raw, hit = own.cast("binary"), F.col("_hash").isNotNull()
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_spans", lambda s: s["end"]))
    starts = F.concat(F.transform("_spans", lambda s: s["start"]), F.array(F.octet_length(own).cast("long")))
    pieces = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")).cast("string"))
    left = met.where(~hit | F.col("_spans").isNotNull()).withColumn("cleaned", F.when(hit, F.array_join(pieces, "\n")).otherwise(own))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.col("cleaned").alias("text"))
        elif f.name == "n_chars":
            columns.append(F.when(hit, F.length("cleaned")).otherwise(F.col("row")[f.name]).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col("row")[f.name].alias(f.name))
    return left.select(*columns)
