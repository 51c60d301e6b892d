"""Log-probabilities of documents under a language model learnt from the others.

The model interpolates, word by word, a causal self-attention model over subword ids
(:mod:`loanmart.llm.attention`) with the word's share of the training corpus:
P(word) = w * P_attention(ids of the word | ids before) + (1 - w) * count / N. Words are
encoded one by one as a space and the word, and a text closes with an end.

What is gathered from the corpus is whole: word counts, subword counts and the output layer's
shares come from every training document. The attention weights are learnt in rounds: each
training document gives all its words to one round, every task takes gradient steps
from the round's weights, and the tasks' weights are averaged.

Every text is cut and encoded once, where it is read: documents become numbers of words in the
table of distinct words of their window, some megabytes of successive texts. Training reads the
subword ids kept with them; for scoring, the rows of each word meet, get its count and come back
to their windows, so neither the vocabulary nor more documents than a window are ever
broadcast, collected or held by a task. Words are told apart by 64-bit hashes.

Defined results: a NULL or empty text is the end alone. Without training documents the score
is that of the untrained attention model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.attention import SPAN, STEP_CHUNKS, Layout, Model, chunks_of, initial
from loanmart.llm.bpe import MAX_WORDS, SpacedWordStore, vocabulary
from loanmart.llm.common import BLOCK_BYTES, LOWER, NOT_SPACE, crc_bucket, materialize, offsets_of, segment_arange, span_hashes, text_blocks, word_spans

#: Rounds of training, and passes over the texts of a round, whatever the size of a block.
ROUNDS, PASSES = 4, 1
#: Weight of the attention model in the interpolation.
ATTENTION_WEIGHT = 0.7
#: Chunks of positions scored at once.
BATCH_CHUNKS = 4096
#: Text bytes of the documents that share a table of distinct words.
WINDOW_BYTES = 16 << 20
#: Weights that meet as one row.
PART = 4096


class Words:
    """Words of a block of texts: distinct hashes and codes, and the row of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        import pandas as pd

        self.data = LOWER[data]
        self.starts, self.ends, self.row = word_spans(self.data, offsets, NOT_SPACE)
        self.n_rows = len(offsets) - 1
        self.codes, self.distinct = pd.factorize(span_hashes(self.data, self.starts, self.ends))

    def numbers(self, store: SpacedWordStore) -> np.ndarray:
        """Number of each word in a store, which gets the words that it lacks."""
        blocks = np.zeros(len(self.distinct), np.int64)
        return store.add(self.distinct, blocks, lambda _, places: self.bytes_of(places))[self.codes]

    def bytes_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of some distinct words one after the other, and their lengths."""
        first = np.zeros(len(self.distinct), np.int64)
        first[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
        at = first[places]
        sizes = self.ends[at] - self.starts[at]
        return self.data[np.repeat(self.starts[at], sizes) + segment_arange(sizes)], sizes


def id_type(path: str) -> type:
    return np.uint16 if vocabulary(path).size <= 1 << 16 else np.uint32


def _places(bounds: np.ndarray, width: int):
    """Byte places of the values of all rows, for the first byte of each value, then the second, ..."""
    sizes = np.diff(bounds)
    each = np.repeat(sizes, sizes)
    at = np.arange(len(each)) + np.repeat(bounds[:-1] * (width - 1), sizes)
    for _ in range(width):
        yield at
        at = at + each


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of values as a column of bytes."""
    at = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def planes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The same with all first bytes of a run, then all second ones, ...: the higher bytes of small numbers compress well."""
    width = values.itemsize
    own, out = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width), np.empty(len(values) * width, np.uint8)
    for k, at in enumerate(_places(bounds, width)):
        out[at] = own[:, k]
    return binaries(out, bounds * width)


def values_of(data: np.ndarray, offsets: np.ndarray, dtype) -> np.ndarray:
    """Values of the runs of a block of such a column, one after the other."""
    width = np.dtype(dtype).itemsize
    out = np.empty((len(data) // width, width), np.uint8)
    for k, at in enumerate(_places(offsets // width, width)):
        out[:, k] = data[at]
    return out.view(dtype)[:, 0]


def spelled(ids: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some words of a table of words, one after the other, and how many each has."""
    each = lengths[numbers]
    return ids[np.repeat(offsets_of(lengths)[numbers], each) + segment_arange(each)], each


def encode_words(docs: DataFrame, path: str) -> DataFrame:
    """Texts (doc_id, held_out, turn, text) as words of windows, each encoded once.

    Kind 0, documents: doc_id, held_out, turn, the window, the 32-bit places of the words in it,
    and, of training documents, the subword ids (16 bits where they fit, else 32). Kind 1, the
    distinct words of a window: their place, hash, ids and count n in training documents. Kind 2,
    counts n in training documents of subword ids (word).
    """
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    columns = [("kind", pa.int32()), ("window", pa.int64()), ("doc_id", None), ("held_out", pa.bool_()), ("turn", pa.int32()), ("words", pa.binary()), ("ids", pa.binary()), ("place", pa.int32()), ("word", pa.int64()), ("n", pa.int64())]

    def run(batches):
        vocab, dtype = vocabulary(path), id_type(path)
        subwords = np.zeros(vocab.size, np.int64)
        window, size, store, counts = TaskContext.get().partitionId() << 32, 0, SpacedWordStore(vocab), np.zeros(0, np.int64)
        doc_type = None

        def out(rows, kind, **given):
            given |= {"kind": pa.array(np.full(rows, kind), pa.int32()), "window": pa.array(np.full(rows, window), pa.int64())}
            return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(rows, t or doc_type) for c, t in columns], [c for c, _ in columns])

        def close():
            word = np.empty(len(store.lengths), np.uint64)
            word[store.number] = store.hashes
            subwords[:] += np.bincount(store.ids, weights=np.repeat(counts, store.lengths), minlength=len(subwords)).astype(np.int64)
            begin = offsets_of(store.lengths)
            for a in range(0, len(word), 100_000):
                b = min(a + 100_000, len(word))
                ids = binaries(store.ids[begin[a] : begin[b]].astype(dtype), begin[a : b + 1] - begin[a])
                yield out(b - a, 1, place=pa.array(np.arange(a, b), pa.int32()), word=pa.array(word[a:b].view(np.int64)), ids=ids, n=pa.array(counts[a:b]))

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                words, held_out = Words(data, offsets), batch.column("held_out").slice(lo, hi - lo)
                numbers = words.numbers(store)
                ids, each = spelled(store.ids, store.lengths, numbers)
                trains = ~held_out.to_numpy(zero_copy_only=False)[words.row]
                seen = np.bincount(numbers[trains], minlength=len(store.lengths))
                seen[: len(counts)] += counts
                counts = seen
                bounds = offsets_of(np.bincount(words.row, minlength=hi - lo))
                learnt = pc.if_else(held_out, pa.scalar(None, pa.binary()), binaries(ids.astype(dtype), offsets_of(each)[bounds]))
                yield out(hi - lo, 0, doc_id=batch.column("doc_id").slice(lo, hi - lo), held_out=held_out, turn=batch.column("turn").slice(lo, hi - lo), words=planes(numbers.astype(np.int32), bounds), ids=learnt)
                size += len(data)
                if size >= WINDOW_BYTES or len(store.lengths) > MAX_WORDS:
                    yield from close()
                    window, size, store, counts = window + 1, 0, SpacedWordStore(vocab), np.zeros(0, np.int64)
        if doc_type is not None:
            yield from close()
            used = np.flatnonzero(subwords)
            yield out(len(used), 2, word=pa.array(used), n=pa.array(subwords[used]))

    schema = f"kind int, window long, doc_id {id_kind}, held_out boolean, turn int, words binary, ids binary, place int, word long, n long"
    return docs.select("doc_id", "held_out", "turn", "text").mapInArrow(run, schema)


def _train_round(docs: DataFrame, path: str, layout, flat: np.ndarray, state: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and optimiser state after one round over the ids of documents (or over texts):
    means over the tasks, by positions learnt."""
    if "ids" not in docs.columns:
        docs = encode_words(docs.select(F.lit(0).alias("doc_id"), F.lit(False).alias("held_out"), F.lit(0).alias("turn"), "text"), path).where("kind = 0")
    shared = docs.sparkSession.sparkContext.broadcast((layout, flat, state))

    def run(batches):
        layout, flat, state = shared.value
        flat, state = flat.copy(), state.copy()
        model, learnt, dtype = Model(flat, layout), 0, np.dtype(id_type(path))
        rng = np.random.default_rng(len(flat))
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("ids"), BLOCK_BYTES * 3 // 4):
                if not len(data):
                    continue
                rows, before, has_before, target, real, _, _ = chunks_of(data.view(dtype), offsets // dtype.itemsize, layout, end)
                target, real = target.reshape(-1, SPAN), real.reshape(-1, SPAN)
                for _ in range(PASSES):
                    order = rng.permutation(len(rows))
                    for k in range(0, len(order), STEP_CHUNKS):
                        q = order[k : k + STEP_CHUNKS]
                        if real[q].any():
                            model.step(rows[q], before[q], has_before[q], target[q].ravel(), real[q].ravel(), state)
                learnt += int(real.sum())
        if learnt:
            every = np.concatenate([flat, state])
            parts = -(-len(every) // PART)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts), pa.int32()), binaries(every, np.minimum(np.arange(parts + 1) * PART, len(every))), pa.array(np.full(parts, learnt), pa.int64())], ["part", "weights", "learnt"])

    def mean(batches):
        sums, learnt = {}, {}  # of the task's parts
        for batch in batches:
            for part, weights, n in zip(batch.column("part").to_pylist(), batch.column("weights"), batch.column("learnt").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(weights.as_buffer(), np.float32).astype(float) * n
                learnt[part] = learnt.get(part, 0) + n
        for part in sums:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(sums[part] / learnt[part]).astype(np.float32).tobytes()], pa.binary())], ["part", "weights"])

    told = docs.select("ids").mapInArrow(run, "part int, weights binary, learnt long").repartition("part").mapInArrow(mean, "part int, weights binary")
    out = np.concatenate([flat, state])
    for r in told.collect():  # the weights of the model once
        out[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["weights"], np.float32)
    return out[: len(flat)], out[len(flat) :]


def _score_block(per_row, ids, each, count, model: Model, layout, end: int, n_train: int, n_end: int, log_base: float):
    """(tokens, known, base score, score) of the rows of a block; counts by word."""
    n = len(per_row)
    row = np.repeat(np.arange(n), per_row)
    bounds = offsets_of(each)[offsets_of(per_row)]
    rows, _, has_before, target, _, place, ends = chunks_of(ids, bounds, layout, end)
    logs = np.empty(len(target))
    for k in range(0, len(rows), BATCH_CHUNKS):
        s, t = slice(k, k + BATCH_CHUNKS), slice(k * SPAN, (k + BATCH_CHUNKS) * SPAN)
        logs[t] = model.id_logs(rows[max(0, k - 1) : k + BATCH_CHUNKS], has_before[s], target[t])
    by_word = np.add.reduceat(logs[place], offsets_of(each)[:-1]) if len(each) else np.zeros(0)
    share = np.array([1.0, 0.0]) if not n_train else np.array([ATTENTION_WEIGHT, 1 - ATTENTION_WEIGHT])
    with np.errstate(divide="ignore"):
        mixed = np.logaddexp(np.log(share[0]) + by_word, np.log(share[1]) + np.log(count / max(n_train, 1)))
        closing = np.logaddexp(np.log(share[0]) + logs[ends], np.log(share[1]) + np.log(n_end / max(n_train, 1)))
    score = (np.bincount(row, weights=mixed, minlength=n) + closing) / np.log(10)
    base = np.bincount(row, weights=np.log10(count + 0.1), minlength=n) + np.log10(n_end + 0.1) - (per_row + 1) * log_base
    known = np.bincount(row, weights=count > 0, minlength=n).astype(np.int64) + (n_end > 0)
    return per_row + 1, known, base, score


def score_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Documents whose crc32 modulo 10 is 0 are held out of all learning.
    """
    spark = docs.sparkSession
    turn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(ROUNDS * 7919)) % ROUNDS
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (crc_bucket("doc_id", 10) == 0).alias("held_out"))
    told = materialize(encode_words(rows.withColumn("turn", turn.cast("int")), path), "lm-words", "zstd")
    end = next(iter(vocabulary(path).specials.values()))

    texts, words = told.where("kind = 0"), told.where("kind = 1")
    # a word has one row for each window it occurs in
    same = Window.partitionBy("word")
    known = words.select(F.col("window").alias("of"), "place", "ids", "n", F.sum("n").over(same).alias("c"), (F.min("window").over(same) == F.col("window")).alias("first"))
    known = materialize(known, "lm-counts", "zstd")
    total = known.where("c > 0").agg(F.sum("n").alias("n"), F.count_if("first").alias("v")).first()
    n_end = texts.where("not held_out").count()
    n_train, n_words = (total["n"] or 0) + n_end, total["v"] + (n_end > 0)
    log_base = float(np.log10(n_train + 0.1 * (n_words + 1)))

    subwords = np.zeros(vocabulary(path).size)
    found = told.where("kind = 2").groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # at most the tokenizer's ids
    subwords[found["word"].to_numpy(np.int64)] = found["n"].to_numpy()
    subwords[end] = n_end
    layout = Layout(subwords, vocabulary(path).bytes_of, end)
    flat = initial(layout)
    state = np.full_like(flat, 1e-6)
    for k in range(ROUNDS):
        flat, state = _train_round(texts.where(~F.col("held_out") & (F.col("turn") == k)), path, layout, flat, state, end)
    shared = spark.sparkContext.broadcast((layout, flat))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(texts: pa.Table, vocab: pa.Table) -> pa.Table:
        layout, flat = shared.value
        model, dtype = Model(flat.copy(), layout), np.dtype(id_type(path))
        vocab = vocab.sort_by("place")
        c, lengths = vocab.column("c").to_numpy().astype(float), pc.binary_length(vocab.column("ids")).to_numpy().astype(np.int64) // dtype.itemsize
        vocab_ids = np.concatenate([np.zeros(0, dtype), *(part[2].view(dtype) for chunk in vocab.column("ids").chunks for part in text_blocks(chunk))])
        out = []
        for batch in texts.to_batches():
            for lo, hi, data, offsets in text_blocks(batch.column("words"), BLOCK_BYTES // 2):
                numbers = values_of(data, offsets, np.int32)
                ids, each = spelled(vocab_ids, lengths, numbers)
                tokens, n_known, base, total = _score_block(np.diff(offsets) // 4, ids, each, c[numbers], model, layout, end, n_train, n_end, log_base)
                out.append(pa.Table.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(np.full(hi - lo, n_train), pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64())], names))
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in zip(names, (texts.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))})

    both = texts.select("window", "doc_id", "held_out", "words").groupBy("window").cogroup(known.select("of", "place", "ids", "c").groupBy("of"))
    return both.applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
