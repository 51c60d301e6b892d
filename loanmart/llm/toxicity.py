"""Toxicity scores by FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of the beginnings of longer words, of
word pairs and of pairs with one word between them. The learner keeps a rate per coordinate and an L1 penalty that leaves most
weights at exactly zero, so the model is a few thousand numbers; its size is bounded by the
features of the bounded training sample. Labelled rows for training are the
``rows_per_class`` smallest by a hash of the id, for each class; the intercept is put right
for that choice, so scores are probabilities over all labelled rows.

Defined results: NULL and empty texts get the intercept's score; rows with a NULL label or id
don't train; without labels of both classes every score is the share of toxic labels (0
without labels); repeated labels of one document count once, the highest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import ALNUM, BASE, LOWER, crc_bucket, materialize, mix, one_text, run_hashes, schema_with, span_hashes, text_blocks, word_spans

BITS = 22
#: Beginnings of longer words, in bytes, that count as words of their own (crude stems).
STEMS = (5, 7)
#: FTRL: per-coordinate rate, its smoothing, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 3.0, 1.0, 12.0, 0.0, 8
#: Labelled rows that train, for each class.
ROWS_PER_CLASS = 4000


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features (with repeats) of all rows, and the row of each."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets, ALNUM)
    words = span_hashes(data, starts, ends)
    stems = [_prefix_hashes(data, starts, ends, k) for k in STEMS]
    pairs = run_hashes(words, 2)
    skips = mix(words[:-2] * BASE + (words[2:] ^ BASE)) if len(words) > 2 else np.zeros(0, np.uint64)
    same1, same2 = row[:-1] == row[1:], row[:-2] == row[2:]
    shift = np.uint64(64 - BITS)
    hashes = [words, pairs[same1] if len(pairs) else pairs, skips[same2] if len(skips) else skips, *(h for h, _ in stems)]
    rows = [row, row[:-1][same1], row[:-2][same2], *(row[at] for _, at in stems)]
    return (np.concatenate(hashes) >> shift).astype(np.int64), np.concatenate(rows)


def _prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the longer words, and which words those are."""
    at = np.flatnonzero(ends - starts > size)
    return span_hashes(data, starts[at], starts[at] + size) ^ np.uint64(size), at


def _distinct(feature: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((row << BITS) | feature)
    return key & ((1 << BITS) - 1), key >> BITS


def ftrl(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, intercept) with non-zero weights, learnt row by row."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    vocab, places = np.unique(flat, return_inverse=True)
    often = np.bincount(places, minlength=len(vocab)) > 1  # a feature of one row teaches nothing
    z, n, w = np.zeros(len(vocab) + 1), np.zeros(len(vocab) + 1), np.zeros(len(vocab) + 1)
    bias = len(vocab)
    cuts = np.cumsum([len(r) for r in rows])[:-1]
    own = [np.append(p[often[p]], bias) for p in np.split(places, cuts)]
    order = np.arange(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(PASSES):
        rng.shuffle(order)
        for i in order:
            at = own[i]
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
            wi[-1] = -zi[-1] / ((BETA + np.sqrt(ni[-1])) / ALPHA)  # no penalty on the intercept
            g = 1 / (1 + np.exp(-np.clip(wi.sum(), -30, 30))) - labels[i]
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - sigma * wi
            n[at] = ni + g * g
    w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    w[bias] = -z[bias] / ((BETA + np.sqrt(n[bias])) / ALPHA)
    kept = np.flatnonzero(w[:-1])
    return vocab[kept], w[kept], float(w[bias])


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[np.ndarray, np.ndarray, float]:
    """Model from (doc_id, text) and (doc_id, toxic 0/1); labels of other documents are ignored."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_y"))
             .where("_y in (0, 1)").join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    totals = dict(known.groupBy("_y").count().collect())
    if len(totals) < 2:
        share = 1.0 if 1 in totals else 0.0
        return np.zeros(0, np.int64), np.zeros(0), 30.0 if share else -30.0
    sample = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        sample = part if sample is None else sample.unionByName(part)
    sample = materialize(sample, "toxic-sample")  # at most 2 * rows_per_class ids: small enough to broadcast
    chosen = one_text(docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(sample), "doc_id"))

    def extract(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("_text")):
                feature, row = _distinct(*features(data, offsets))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).cast(pa.string()), batch.column("_y").slice(lo, hi - lo), lists], ["id", "y", "features"])

    def learn(batches):
        rows, ys, ids = [], [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            ys += batch.column("y").to_pylist()
            rows += [np.asarray(x.values).astype(np.int64) for x in batch.column("features")]
        if rows:
            order = sorted(range(len(rows)), key=ids.__getitem__)
            feature, weight, intercept = ftrl([rows[i] for i in order], np.array([ys[i] for i in order], float))
            yield pa.RecordBatch.from_arrays([pa.array([feature.tolist()], pa.list_(pa.int64())), pa.array([weight.tolist()], pa.list_(pa.float64())), pa.array([intercept], pa.float64())], ["feature", "weight", "intercept"])

    extracted = chosen.select("doc_id", "_y", "_text").mapInArrow(extract, "id string, y int, features array<int>")
    model = extracted.repartition(1).mapInArrow(learn, "feature array<long>, weight array<double>, intercept double").first()
    taken = {y: min(totals[y], rows_per_class) for y in (0, 1)}
    shift = np.log((totals[1] / taken[1]) / (totals[0] / taken[0]))
    return np.array(model["feature"], np.int64), np.array(model["weight"]), model["intercept"] + float(shift)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the toxicity score of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    picked = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        vocab, weight, intercept = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[vocab] = weight
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("_text")):
                feature, row = features(data, offsets)
                used = table[feature] != 0
                feature, row = _distinct(feature[used], row[used])
                margin = intercept + np.bincount(row, weights=table[feature], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(margin, -700, 700))), pa.float64())], [*keep, "score"])

    return picked.mapInArrow(run, schema_with(picked.drop("_text"), "score double"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learnt from labels of those whose crc32 modulo 3 is not 1."""
    ids = docs.select("doc_id", "text", (crc_bucket("doc_id", 3) == 1).alias("held_out"))
    model = fit(ids.where("not held_out"), labels)
    return score(ids, model, ("doc_id", "held_out")).withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))
