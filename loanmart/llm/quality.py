"""Quality classifier: ordinal cumulative-link (proportional odds) regression on graded ratings.

P(grade <= k | x) = sigmoid(theta_k - w.x): one weight vector over hashed text features is
shared by all grades, the thresholds are kept in order. It gives the expected grade and the
tail probability P(grade >= k) that selects documents.

Features are hashed shares of a text's tokens: word shapes (letters, capitals and digits
collapsed, other characters kept), pairs of shapes, words, and repeats of the word before or
of the word two before. They come from the whole text.

Training uses the ``rows_per_grade`` smallest rows of each grade by a hash of the id; the
model is a dense vector of 2**BITS weights and the thresholds, whatever the input.

Defined results: a NULL or empty text has the features of an empty text (intercepts only);
rows with a NULL id or grade don't train; with ratings of one grade only, every text gets that
grade; without ratings, every document is kept with expected grade 0; of repeated ratings of one
document the lowest counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.llm.common import LOWER, NOT_SPACE, crc_bucket, materialize, mix, offsets_of, one_text, run_hashes, schema_with, span_hashes, text_blocks, word_spans

BITS = 16
ROWS_PER_GRADE = 4000
#: Text bytes whose features are made at once; their arrays take about a hundred times as much.
SPLIT_BYTES = 1 << 20
#: Full passes of the optimiser, its step, and the L2 penalty.
STEPS, STEP, L2 = 300, 0.3, 1e-5
#: A document is selected when P(grade >= KEEP_GRADE) is at least KEEP_SHARE.
KEEP_GRADE, KEEP_SHARE = 1, 0.5

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x61:0x7B] = SHAPE[0x80:] = 0x61  # letters in one class; capitals and digits in two others
SHAPE[0x41:0x5B] = 0x41
SHAPE[0x30:0x3A] = 0x30


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all rows, each pair of row and feature once."""
    starts, ends, row = word_spans(data, offsets, NOT_SPACE)
    n = len(offsets) - 1
    shaped = SHAPE[data]
    kept = np.ones(len(data), bool)  # first of each run of one class; words start anew
    kept[1:] = shaped[1:] != shaped[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shapes = span_hashes(shaped[kept], place[starts], place[ends])
    words = span_hashes(LOWER[data], starts, ends)
    pairs = run_hashes(shapes, 2)
    same1, same2 = row[:-1] == row[1:], row[:-2] == row[2:]
    again1 = (words[:-1] == words[1:])[same1] if len(words) > 1 else np.zeros(0, bool)
    again2 = (words[:-2] == words[2:])[same2] if len(words) > 2 else np.zeros(0, bool)
    groups = [(shapes, row), (pairs[same1] if len(pairs) else pairs, row[:-1][same1]), (words, row), (again1.astype(np.uint64) + np.uint64(1), row[:-1][same1]), (again2.astype(np.uint64) + np.uint64(3), row[:-2][same2])]
    keys, weights = [], []
    for k, (h, r) in enumerate(groups):
        h = mix(h + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
        keys.append((r.astype(np.int64) << BITS) | (h >> np.uint64(64 - BITS)).astype(np.int64))
        per_row = np.bincount(r, minlength=n)
        weights.append(1.0 / per_row[r])  # a share of the row's tokens
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key >> BITS, key & ((1 << BITS) - 1), np.sqrt(np.bincount(at, weights=np.concatenate(weights), minlength=len(key)))


#: Entries of the training rows that one step looks at together.
CHUNK = 1 << 20


def cumulative_link(x, grades: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by AdaGrad on the mean log-likelihood; x: (row, feature, value), rows ascending."""
    row, feature, value = x
    return fitted_link(np.bincount(row, minlength=len(grades)), feature, value, grades, n_grades)


def fitted_link(entries: np.ndarray, feature: np.ndarray, value: np.ndarray, grades: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from the number of entries of each row and the rows' entries one after the other.

    Besides the entries a step holds one chunk of them.
    """
    used = np.flatnonzero(np.bincount(feature, minlength=1 << BITS))
    number = np.zeros(1 << BITS, np.uint16)
    number[used] = np.arange(len(used))
    place, n = number[feature], len(grades)
    at = offsets_of(entries)
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, at[-1], CHUNK), "right") - 1, [0, n]))
    chunks = [(a, b, at[a], at[b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    w, gw = np.zeros(len(used)), np.full(len(used), 1e-8)
    first = np.searchsorted(np.cumsum(np.bincount(grades, minlength=n_grades)) / n, 0.5)
    base, gaps = -0.5 * max(int(first), 1), np.zeros(max(n_grades - 2, 0))
    gb, gg = 1e-8, np.full(len(gaps), 1e-8)
    sig = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    for _ in range(STEPS):
        theta = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        m = np.concatenate([np.bincount(np.repeat(np.arange(b - a), entries[a:b]), weights=w[place[lo:hi]] * value[lo:hi], minlength=b - a) for a, b, lo, hi in chunks])
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = sig(edges[grades + 1] - m), sig(edges[grades] - m)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        dm = (dhi - dlo) / n  # of the negative log-likelihood
        dtheta = np.array([(-dhi[grades == k].sum() + dlo[grades == k + 1].sum()) / n for k in range(n_grades - 1)])
        g = L2 * w
        for a, b, lo, hi in chunks:
            g += np.bincount(place[lo:hi], weights=np.repeat(dm[a:b], entries[a:b]) * value[lo:hi], minlength=len(used))
        gw += g * g
        w -= STEP * g / np.sqrt(gw)
        dbase, dgaps = dtheta.sum(), np.array([dtheta[k + 1 :].sum() for k in range(len(gaps))]) * np.exp(gaps) if len(gaps) else gaps
        gb += dbase * dbase
        base -= STEP * dbase / np.sqrt(gb)
        if len(gaps):
            gg += dgaps * dgaps
            gaps -= STEP * dgaps / np.sqrt(gg)
    out = np.zeros(1 << BITS, np.float32)
    out[used] = w
    return out, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 for quality 0, 1 for good but toxic documents, 2 for good ones."""
    good, toxic = F.col("quality").cast("int"), F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    return labels.where("doc_id is not null and quality is not null").select("doc_id", F.when(good < 1, 0).when(toxic > 0, 1).otherwise(2).alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, rows_per_grade: int = ROWS_PER_GRADE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, thresholds, grade values) from (doc_id, text) and (doc_id, grade)."""
    known = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("_y")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    values = np.array(sorted(r[0] for r in known.select("_y").distinct().collect()), float)
    if len(values) < 2:
        return np.zeros(1 << BITS, np.float32), np.zeros(0), values if len(values) else np.zeros(1)
    sample = None
    for y in values.tolist():
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_grade)
        sample = part if sample is None else sample.unionByName(part)
    sample = materialize(sample, "quality-sample")  # grades * rows_per_grade ids: small enough to broadcast
    chosen = one_text(docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(sample), "doc_id"))

    def extract(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("_text"), SPLIT_BYTES):
                row, feature, value = features(data, offsets)
                cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).cast(pa.string()), batch.column("_y").slice(lo, hi - lo).cast(pa.float64()), pa.ListArray.from_arrays(cut, pa.array(feature, pa.int32())), pa.ListArray.from_arrays(cut, pa.array(value, pa.float32()))], ["id", "y", "feature", "value"])

    def learn(batches):
        ids, ys, fs, vs = [], [], [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            ys += batch.column("y").to_pylist()
            fs += [np.asarray(x.values) for x in batch.column("feature")]
            vs += [np.asarray(x.values) for x in batch.column("value")]
        if ids:
            order = sorted(range(len(ids)), key=ids.__getitem__)
            grade = np.searchsorted(values, [ys[i] for i in order])
            entries = np.array([len(fs[i]) for i in order])
            feature, value = np.concatenate([fs[i] for i in order]), np.concatenate([vs[i] for i in order])
            fs.clear()
            vs.clear()
            w, theta = fitted_link(entries, feature, value, grade, len(values))
            yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float32())), pa.array([theta.tolist()], pa.list_(pa.float64()))], ["w", "theta"])

    model = chosen.mapInArrow(extract, "id string, y double, feature array<int>, value array<float>").repartition(1).mapInArrow(learn, "w array<float>, theta array<double>").first()
    return np.array(model["w"], np.float32), np.array(model["theta"]), values


def _graded(texts: pa.Array, model, keep_grade: float):
    """(first row, end row, expected grade, tail probability, selected) of row ranges of texts."""
    w, theta, values = model
    for lo, hi, data, offsets in text_blocks(texts, SPLIT_BYTES):
        row, feature, value = features(data, offsets)
        m = np.bincount(row, weights=w[feature] * value, minlength=hi - lo)
        above = 1 / (1 + np.exp(np.clip(theta[None, :] - m[:, None], -40, 40)))  # P(grade > k)
        expected = values[0] + (above * np.diff(values)[None, :]).sum(axis=1)
        k = int(np.searchsorted(values, keep_grade))
        tail = np.ones(hi - lo) if k == 0 else np.zeros(hi - lo) if k == len(values) else above[:, k - 1]
        yield lo, hi, expected, tail, tail >= KEEP_SHARE if len(theta) else np.ones(hi - lo, bool)


def score(docs: DataFrame, model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", keep_grade: float = KEEP_GRADE) -> DataFrame:
    """``keep`` columns, expected_grade, tail_probability (of a grade >= keep_grade) and selected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(*keep, F.col(text).alias("_text"))
    schema = schema_with(picked.drop("_text"), "expected_grade double, tail_probability double, selected boolean")

    def run(batches):
        for batch in batches:
            for lo, hi, expected, tail, selected in _graded(batch.column("_text"), shared.value, keep_grade):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array(selected)], [*keep, "expected_grade", "tail_probability", "selected"])

    return picked.mapInArrow(run, schema)


def selects(spark: SparkSession, model, keep_grade: float = KEEP_GRADE):
    """Column function that says of a text whether the classifier selects it."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def selected(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, bool), *(part[-1] for part in _graded(texts, shared.value, keep_grade))]))

    return selected


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Grades of all documents, learnt from those whose crc32 modulo 5 is not 1 (held_out)."""
    ids = docs.select("doc_id", "text", (crc_bucket("doc_id", 5) == 1).alias("held_out"))
    return score(ids, fit(ids.where("not held_out"), grades_of(labels)), ("doc_id", "held_out"))


def keep_selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier selects, with their columns; learnt from all ratings."""
    model = fit(docs, grades_of(labels))
    # a filter: only texts go to the classifier and only flags come back, no row is shuffled
    return docs.where(selects(docs.sparkSession, model)("text"))
