"""Byte-level BPE encoding and decoding through a pair occurrence index.

A task cuts its texts into pre-tokens by the class of each character, finds the distinct
ones, and encodes those together: an index maps every adjacent pair that has a rank to all
its positions; ranks that occur are applied in ascending order, each to all its positions
at once, and the lists of the pairs beside them are updated. A merge only makes pairs of
higher rank, so one ascending sweep gives the same ids as merging word by word.

Texts go through in blocks and known pre-tokens are kept between blocks (up to a bound), so
memory does not grow with the partition.

Defined results: a NULL text encodes as the empty text (no ids); special tokens in a text
become their ids, as the tokenizer does without ``encode_special_tokens``.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import offsets_of, schema_with, segment_arange, span_hashes, text_blocks

#: GPT-2 pre-tokenizer pattern of ByteLevel(use_regex=True) (fixed by the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens known by a task before it starts again with an empty store.
MAX_WORDS = 2_000_000
#: Text bytes whose new pre-tokens are encoded in one sweep.
SWEEP_BYTES = 4 << 20
#: Bytes of them split and hashed at once.
SPLIT_BYTES = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges as sorted numeric pairs, ids of bytes, bytes of ids, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, chars = spec["model"]["vocab"], byte_alphabet()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in chars.items():
            self.byte_id[b] = ids[c]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(max(ids.values()), *self.specials.values())
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(chars[c] for c in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        key = self.left * self.size + self.right
        self.rank_of = np.argsort(key, kind="stable")
        self.keys = np.append(key[self.rank_of], np.iinfo(np.int64).max)
        self.rank_of = np.append(self.rank_of, -1)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def encode_words(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words whose bytes follow one another in data, and the number of each."""
        symbols = self.byte_id[data]
        n = len(symbols)
        if not n:
            return symbols, lengths
        bounds = offsets_of(lengths)
        after = np.arange(1, n + 1, dtype=np.int64)  # next symbol of the word; n: none
        after[bounds[1:][lengths > 0] - 1] = n
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[bounds[:-1][lengths > 0]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(ranks: np.ndarray, at: np.ndarray) -> None:
            """File positions under the rank of the pair that starts there."""
            keep = ranks >= 0
            ranks, at = ranks[keep], at[keep]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.concatenate([[0], cut])].tolist(), np.split(at, cut)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        firsts = np.flatnonzero(after < n)
        add(self.ranks(symbols[firsts], symbols[after[firsts]]), firsts)
        tail = np.append(symbols, -1)  # tail[n] = -1 stands for "no symbol"
        while heap:
            rank = heapq.heappop(heap)
            parts = index.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            a, b = self.left[rank], self.right[rank]
            nxt = after[at]
            ok = alive[at] & (tail[at] == a) & (tail[nxt] == b)
            at, nxt = at[ok], nxt[ok]
            if a == b and len(at) > 1:
                at = np.sort(at)
                nxt = after[at]
                # in a run of equal symbols every second pair counts, from the left
                linked = np.append(False, nxt[:-1] == at[1:])
                start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                keep = (np.arange(len(at)) - start) % 2 == 0
                at, nxt = at[keep], nxt[keep]
            if not len(at):
                continue
            tail[at] = self.merged[rank]
            alive[nxt] = False
            tail[nxt] = -1
            beyond = after[nxt]
            after[at] = beyond
            inner = beyond < n
            before[beyond[inner]] = at[inner]
            prior = before[at]
            has = prior >= 0
            has &= tail[prior] != self.merged[rank]  # a neighbour merged just now files that pair itself
            left, here, right = prior[has], at[inner], beyond[inner]
            starts = np.concatenate([left, here])
            pair_ranks = self.ranks(np.concatenate([tail[left], tail[here]]), np.concatenate([tail[after[left]], tail[right]]))
            add(pair_ranks, starts)
        kept = np.flatnonzero(alive)
        counts = np.bincount(np.searchsorted(bounds, kept, "right") - 1, minlength=len(lengths))
        return tail[kept].astype(np.int32), counts.astype(np.int64)

    def decode(self, ids) -> str:
        """Text of a sequence of ids, with replacement characters for broken UTF-8."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class TokenStore:
    """Ids of distinct pre-tokens, found again by hash; new ones are encoded together."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.number = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.vocab.encode_words(data, lengths)

    def add(self, hashes: np.ndarray, block_of: np.ndarray, words_of) -> np.ndarray:
        """Number of each distinct hash; words_of(block, places) gives the bytes of some of them."""
        if len(self.hashes) > MAX_WORDS:
            self.__init__(self.vocab)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        out = np.empty(len(hashes), np.int64)
        out[known] = self.number[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(block_of[new], kind="stable")]
            parts = [words_of(k, new[block_of[new] == k]) for k in np.unique(block_of[new]).tolist()]
            flat, counts = self.encode(*map(np.concatenate, zip(*parts)))
            out[new] = len(self.lengths) + np.arange(len(new))
            self.ids = np.concatenate([self.ids, flat])
            self.lengths = np.concatenate([self.lengths, counts])
            merged = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(merged)
            self.hashes, self.number = merged[order], np.concatenate([self.number, out[new]])[order]
        return out


class SpacedWordStore(TokenStore):
    """Ids of distinct words, each encoded as a space and the word."""

    def encode(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bounds = offsets_of(lengths + 1)
        spaced = np.full(bounds[-1], 0x20, np.uint8)
        spaced[np.repeat(bounds[:-1] + 1, lengths) + segment_arange(lengths)] = data
        starts = split_words(spaced, bounds)
        ids, counts = self.vocab.encode_words(spaced, np.diff(np.append(starts, len(spaced))))
        return ids, np.diff(offsets_of(counts)[np.append(np.searchsorted(starts, bounds[:-1]), len(starts))])


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    import regex

    out = np.full(0x110000, 3, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for value, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
        out[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), np.uint32)] = value
    return out


def split_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte starts of the pre-tokens of all rows, as PATTERN cuts each row."""
    point = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(point)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _classes()[point]
    new_row = np.zeros(n + 1, bool)
    new_row[np.searchsorted(place, offsets)] = True
    start = new_row.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # the last white-space character before a word stands alone, or joins the word if a space
    last = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~new_row[1:n])
    start[last] = True
    start[last[point[last] == 0x20] + 1] = False
    quote = np.flatnonzero(start[:n] & (point == 0x27))
    quote = quote[(quote + 1 < n)]
    quote = quote[~new_row[quote + 1]]
    one = point[quote + 1]
    two_at = np.minimum(quote + 2, n - 1)
    two = np.where((quote + 2 < n) & ~new_row[quote + 2], point[two_at], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    return place[np.flatnonzero(start[:n])]


def encode_column(column: pa.Array, store: TokenStore):
    """(first row, ids of all rows one after the other, offsets) of each block of rows."""
    import pandas as pd

    specials = store.vocab.specials
    column = column.fill_null("").cast(pa.large_string())
    for lo, hi, _, _ in text_blocks(column, SWEEP_BYTES):
        texts = column.slice(lo, hi - lo)
        of_row = None
        if any(pc.any(pc.match_substring(texts, t)).as_py() for t in specials):  # cut rows at special tokens
            segments, of_row, is_special = [], [], []
            for i, t in enumerate(texts.to_pylist()):
                for part in re.split("(" + "|".join(map(re.escape, specials)) + ")", t):
                    segments.append("" if part in specials else part)
                    is_special.append(specials.get(part, -1))
                    of_row.append(i)
            texts = pa.array(segments, pa.large_string())
        blocks = []
        for a, b, data, offsets in text_blocks(texts, SPLIT_BYTES):
            starts = split_words(data, offsets) if len(data) else np.zeros(0, np.int64)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            codes, distinct = pd.factorize(span_hashes(data, starts, ends))
            first = np.full(len(distinct), len(codes), np.int64)
            np.minimum.at(first, codes, np.arange(len(codes)))
            blocks.append((codes, distinct, first, data, starts, ends, np.searchsorted(starts, offsets)))
        every, owner = np.unique(np.concatenate([x[1] for x in blocks]) if blocks else np.zeros(0, np.uint64), return_index=True)
        block_of = np.repeat(np.arange(len(blocks)), [len(x[1]) for x in blocks])[owner]
        first_of = np.concatenate([x[2] for x in blocks])[owner] if blocks else owner

        def words_of(k, places, blocks=blocks, first_of=first_of):
            _, _, _, data, starts, ends, _ = blocks[k]
            at = first_of[places]
            sizes = ends[at] - starts[at]
            return data[np.repeat(starts[at], sizes) + segment_arange(sizes)], sizes

        numbers = store.add(every, block_of, words_of)
        begin = offsets_of(store.lengths)
        flats, sizes = [np.zeros(0, np.int32)], []
        for codes, distinct, _, _, _, _, rows in blocks:
            word = numbers[np.searchsorted(every, distinct)][codes]
            each = store.lengths[word]
            flats.append(store.ids[np.repeat(begin[word], each) + segment_arange(each)])
            sizes.append(np.diff(offsets_of(each)[rows]))
        flat, sizes = np.concatenate(flats), np.concatenate(sizes) if sizes else np.zeros(hi - lo, np.int64)
        if of_row is not None:
            put = np.flatnonzero(np.array(is_special) >= 0)
            flat = np.insert(flat, offsets_of(sizes)[put], np.array(is_special, np.int32)[put])
            sizes[put] += 1
            sizes = np.bincount(of_row, weights=sizes, minlength=hi - lo).astype(np.int64)
        bounds = offsets_of(sizes)
        yield lo, flat, bounds


def encode_rows(column: pa.Array, store: TokenStore):
    """(first row, ids of each row, decoded bytes of each row) of each block.

    Decoding gives a text's own bytes back; where it doesn't (two pre-tokens of one hash),
    the row is encoded again word by word.
    """
    pieces = np.array(store.vocab.bytes_of, dtype=object)
    for lo, flat, bounds in encode_column(column, store):
        ids, back = [], []
        for i, text in enumerate(column.slice(lo, len(bounds) - 1)):
            own = flat[bounds[i] : bounds[i + 1]]
            decoded = b"".join(pieces[own].tolist())
            if decoded != (text.as_buffer().to_pybytes() if text.is_valid else b""):
                own = encode_text(text.as_py(), store.vocab)
                decoded = b"".join(pieces[own].tolist())
            ids.append(own)
            back.append(decoded)
        yield lo, ids, back


def encode_text(text: str, vocab: Vocabulary) -> np.ndarray:
    """Ids of one text, without a store."""
    out = [np.zeros(0, np.int32)]
    for part in re.split("(" + "|".join(map(re.escape, vocab.specials)) + ")", text) if vocab.specials else [text]:
        if part in vocab.specials:
            out.append(np.array([vocab.specials[part]], np.int32))
        elif part:
            raw = np.frombuffer(part.encode("utf-8"), np.uint8)
            starts = split_words(raw, np.array([0, len(raw)]))
            out.append(vocab.encode_words(raw, np.diff(np.append(starts, len(raw))))[0])
    return np.concatenate(out)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``decoded`` (text of those ids) of every row."""
    picked = docs.select(*keep, F.col(text).alias("_text"))
    schema = schema_with(picked.drop("_text"), "ids array<int>, decoded string")

    def run(batches):
        store = TokenStore(vocabulary(path))
        for batch in batches:
            for lo, ids, back in encode_rows(batch.column("_text"), store):
                lists = pa.ListArray.from_arrays(pa.array(offsets_of([len(x) for x in ids]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                decoded = pa.array([x.decode("utf-8", errors="replace") for x in back], pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, len(ids)) for c in keep), lists, decoded], [*keep, "ids", "decoded"])

    return picked.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256: the encoding without its ids, or with them."""
    picked = docs.select(*keep, F.col(text).alias("_text"))
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = schema_with(picked.drop("_text"), f"{more}, ids array<int>" if with_ids else more)

    def run(batches):
        store = TokenStore(vocabulary(path))
        for batch in batches:
            for lo, ids, back in encode_rows(batch.column("_text"), store):
                columns = [batch.column(c).slice(lo, len(ids)) for c in keep]
                columns.append(pa.array([len(x) for x in ids], pa.int64()))
                columns.append(pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()))
                columns.append(pa.array([hashlib.sha256(x.decode("utf-8", errors="replace").encode("utf-8")).hexdigest() for x in back], pa.string()))
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets_of([len(x) for x in ids]), pa.int32()), pa.array(np.concatenate(ids), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return picked.mapInArrow(run, schema)
