"""Language identification by Bayesian fusion of evidence.

log P(l | all) = text likelihood + log P(declared | l) + log prior of the host, normalised:

* text: naive Bayes over hashed words and byte trigrams of the whole text, tempered so that a
  long text counts as at most ``TEXT_CAP`` features; learnt from a bounded sample of declared rows.
  A language's share of a feature is mixed with the mean share over all languages, by the same
  weight for all of them: one with few rows gains nothing on features that none has seen;
* declared language (markup attribute or column): a confusion table of declared against text
  language, counted over all rows;
* address: prior of the host, smoothed towards the prior of its suffix (last label), smoothed
  towards the prior of all rows. Counts are sums of the rows' text posteriors, by grouped
  aggregation; a row's own share is taken out of its host's count.

One host may hold a third of all rows: counts combine before the shuffle, and host priors meet
the rows by host and salt, without texts.

Defined results: NULL or empty texts give no text evidence; a NULL or unknown declared language
gives none either; a NULL address is the address ''. Every language that some row declares is
known, whatever the size of the table. The text model is held and applied in blocks of
``BLOCK_LANGUAGES``; a row holds one likelihood for each known language. Without any declared language the
language is NULL with confidence 0. A row is kept if it has words and its confidence reaches
``MIN_CONFIDENCE``. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import ALNUM, LOWER, materialize, run_hashes, schema_with, span_hashes, text_blocks, word_spans

BITS = 16
#: Text bytes whose features are made at once; their arrays take about sixty times as much.
SPLIT_BYTES = 1 << 20
ROWS_PER_LANGUAGE = 2000
#: Weight of the mean over all languages in a language's share of a feature.
MEAN_WEIGHT = 0.3
#: Languages of a block of the text model.
BLOCK_LANGUAGES = 64
TEXT_CAP = 60
#: Pseudo-rows of the smoothing: suffix towards all rows, host towards suffix, confusion table.
SUFFIX_WEIGHT, HOST_WEIGHT, CONFUSION_WEIGHT = 20.0, 20.0, 5.0
MIN_CONFIDENCE = 0.6
SALTS = 16


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and byte trigrams inside words of all rows, and the row of each."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets, ALNUM)
    words = span_hashes(data, starts, ends)
    inside = ALNUM[data].astype(np.int8)
    at = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:]) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + 2, "right")]
    grams = run_hashes(data[: len(data)].astype(np.uint64) + np.uint64(1), 3)[at] if len(at) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - BITS)
    return np.concatenate([words >> shift, grams >> shift]).astype(np.int64), np.concatenate([row, np.searchsorted(offsets, at, "right") - 1])


def feature_blocks(column: pa.Array):
    """(first row, end row, features, row of each in the block) of row ranges of texts."""
    for lo, hi, data, offsets in text_blocks(column, SPLIT_BYTES):
        yield lo, hi, *features(data, offsets)


def one_by_one(blocks: list):
    """Blocks of the model in turn; with several, each is let go before the next is loaded."""
    for b in blocks:
        yield b.value
        if len(blocks) > 1:
            b.__dict__.pop("_value", None)


def languages(records: DataFrame) -> list[str]:
    """All declared languages, in alphabetical order."""
    return sorted(r["declared"] for r in records.where("declared is not null and declared <> ''").select("declared").distinct().collect())


def _sampled(labelled: DataFrame, rows_per_language: int) -> DataFrame:
    """The smallest hashes of each declared language: of each task's rows first, then of all."""

    def least(batches):
        import pandas as pd

        held, size = [], 0

        def cut():
            t = pd.concat(held).sort_values(["declared", "_order"], kind="stable")
            return t[t.groupby("declared").cumcount() < rows_per_language]

        for batch in batches:
            held.append(batch.to_pandas())
            size += batch.num_rows
            if size > 1_000_000:
                held = [cut()]
                size = 0
        if held:
            yield pa.RecordBatch.from_pandas(cut(), pa.schema([("declared", pa.string()), ("_order", pa.int64())]), preserve_index=False)

    schema = "declared string, _order long"
    return labelled.select("declared", "_order").mapInArrow(least, schema).repartition("declared").mapInArrow(least, schema)


def fit_text(records: DataFrame, known: list[str], rows_per_language: int = ROWS_PER_LANGUAGE) -> list:
    """Broadcast log-probabilities (feature, language) of a naive Bayes model, in blocks of languages."""
    spark = records.sparkSession
    number = {x: i for i, x in enumerate(known)}
    if not number:
        return []
    labelled = records.where(F.col("declared").isin(known)).withColumn("_order", F.xxhash64("key", "text"))
    sample = materialize(_sampled(labelled, rows_per_language).select("_order").distinct(), "language-sample")
    chosen = labelled.join(F.broadcast(sample) if len(known) <= BLOCK_LANGUAGES else sample, "_order").select("declared", "text")

    def count(batches):
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("declared").to_pylist()], np.int64)
            for lo, hi, feature, row in feature_blocks(batch.column("text")):
                key, n = np.unique((lang[lo:hi][row] << BITS) | feature, return_counts=True)
                of, first = np.unique(key >> BITS, return_index=True)
                bounds = pa.array(np.append(first, len(key)), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.ListArray.from_arrays(bounds, pa.array(key & ((1 << BITS) - 1), pa.int64())), pa.ListArray.from_arrays(bounds, pa.array(n, pa.int64()))], ["lang", "feature", "n"])

    def total(batches):
        held = {}  # languages of the task
        for batch in batches:
            for lang, feature, n in zip(batch.column("lang").to_pylist(), batch.column("feature"), batch.column("n")):
                held.setdefault(lang, np.zeros(1 << BITS))[np.asarray(feature.values)] += np.asarray(n.values)
        for lang, counts in held.items():
            shares = (counts / max(counts.sum(), 1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.int32()), pa.array([shares.tobytes()], pa.binary())], ["lang", "shares"])

    def add(batches):
        sums = np.zeros(1 << BITS)
        for batch in batches:
            for shares in batch.column("shares"):
                sums += np.frombuffer(shares.as_buffer(), np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    fitted = materialize(chosen.mapInArrow(count, "lang int, feature array<long>, n array<long>").repartition("lang").mapInArrow(total, "lang int, shares binary"), "language-model")
    mean = np.full(1 << BITS, 1.0)  # a pseudo-language that has all features alike
    mean /= mean.sum()
    for r in fitted.mapInArrow(add, "sums binary").toLocalIterator():  # a row of fixed size for each task
        mean += np.frombuffer(r["sums"])
    mean *= MEAN_WEIGHT / (len(known) + 1)
    blocks = []
    for a in range(0, len(known), BLOCK_LANGUAGES):  # one block at a time is in the driver's memory
        block = np.zeros((min(BLOCK_LANGUAGES, len(known) - a), 1 << BITS))
        for r in fitted.where((F.col("lang") >= a) & (F.col("lang") < a + BLOCK_LANGUAGES)).collect():
            block[r["lang"] - a] = np.frombuffer(r["shares"], np.float32)
        block = np.log((1 - MEAN_WEIGHT) * block + mean).astype(np.float32)
        blocks.append(spark.sparkContext.broadcast(np.ascontiguousarray(block.T)))
    return blocks


def text_evidence(records: DataFrame, blocks: list, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns, has_words, and tempered log-likelihoods of the known languages."""
    picked = records.select(*keep, "text")

    def run(batches):
        for batch in batches:
            for lo, hi, feature, row in feature_blocks(batch.column("text")):
                n = np.bincount(row, minlength=hi - lo)
                sums = [np.bincount(row, weights=table[feature, k], minlength=hi - lo) for table in one_by_one(blocks) for k in range(table.shape[1])]
                L = len(sums)
                sums = np.stack(sums, axis=1).astype(float) if L else np.zeros((hi - lo, 0))
                sums *= np.minimum(1.0, TEXT_CAP / np.maximum(n, 1))[:, None]
                sums -= sums.max(axis=1, keepdims=True) if L else 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * L, pa.int32()), pa.array(sums.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array(n > 0), lists], [*keep, "has_words", "likelihood"])

    return picked.mapInArrow(run, schema_with(picked.drop("text"), "has_words boolean, likelihood array<double>"))


def _posterior(likelihood):
    e = F.transform(likelihood, lambda x: F.exp(x))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _summed(df: DataFrame, key: str, L: int) -> DataFrame:
    return df.groupBy(key).agg(F.array(*[F.sum(F.col("share")[k]) for k in range(L)]).alias(f"{key}_counts"))


def identify(records: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Language of every record (key, text, declared, address, and the ``keep`` columns).

    Returns ``keep``, language, confidence, text_language, declared, has_words, kept.
    """
    records = records.select(*dict.fromkeys((*keep, "key")), "text", F.lower(F.trim(F.col("declared"))).alias("declared"), F.coalesce("address", F.lit("")).alias("address"))
    known = languages(records)
    L = len(known)
    blocks = fit_text(records, known)
    host = F.lower(F.when(F.col("address").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.regexp_extract("address", r"^[^:]+://(?:[^/?#@]*@)?([^/:?#]*)", 1)).otherwise(F.col("address")))
    placed = records.withColumn("host", host).withColumn("suffix", F.when(F.instr("host", ".") > 0, F.regexp_extract("host", r"\.([^.]*)$", 1)).otherwise(F.lit("")))
    if not L:
        none = text_evidence(placed, blocks, (*keep, "declared"))
        return none.select(*keep, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_language"), "declared", "has_words", F.lit(False).alias("kept"))
    told = materialize(text_evidence(placed, blocks, (*keep, "declared", "host", "suffix")), "language-text")
    share = F.when(F.col("has_words"), _posterior(F.col("likelihood"))).otherwise(F.array_repeat(F.lit(0.0), L))
    told = told.withColumn("share", share)
    # all rows: how often each declared language goes with each text language
    seen = {r["declared"]: np.array(r["declared_counts"], float) for r in _summed(told.where(F.col("declared").isin(known)), "declared", L).collect()}
    confusion = np.stack([seen.get(x, np.zeros(L)) for x in known]) + CONFUSION_WEIGHT * (0.5 * np.eye(L) + 0.5 / L)
    declared_log = np.log(confusion / confusion.sum(axis=0, keepdims=True))
    whole = told.agg(*[F.sum(F.col("share")[k]) for k in range(L)]).first()
    whole = np.array([x or 0.0 for x in whole]) + 1.0
    whole /= whole.sum()
    # suffixes and hosts may be many: tables, not collected
    hosts = told.groupBy("host", "suffix").agg(F.array(*[F.sum(F.col("share")[k]) for k in range(L)]).alias("host_counts"))
    suffixes = hosts.groupBy("suffix").agg(F.array(*[F.sum(F.col("host_counts")[k]) for k in range(L)]).alias("suffix_counts"))
    # a suffix may have very many hosts: both sides by suffix and salt
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    priors = hosts.withColumn("salt", salt("host")).join(suffixes.select("*", salts.alias("salt")), ["suffix", "salt"]).drop("salt", "suffix")
    met = told.withColumn("salt", salt("likelihood")).join(priors.select("*", salts.alias("salt")), ["host", "salt"])
    names = pa.array(known, pa.string())
    position = {x: i for i, x in enumerate(known)}
    flat = lambda a, n: np.asarray(a.flatten()).reshape(n, L)

    def fuse(batches):
        for batch in batches:
            n = batch.num_rows
            likelihood, own, of_host, of_suffix = (flat(batch.column(c), n) for c in ("likelihood", "share", "host_counts", "suffix_counts"))
            suffix_prior = of_suffix + SUFFIX_WEIGHT * whole
            suffix_prior /= suffix_prior.sum(axis=1, keepdims=True)
            prior = np.maximum(of_host - own, 0) + HOST_WEIGHT * suffix_prior
            prior /= prior.sum(axis=1, keepdims=True)
            logs = likelihood + np.log(prior)
            for i, d in enumerate(batch.column("declared").to_pylist()):
                if d in position:
                    logs[i] += declared_log[position[d]]
            p = np.exp(logs - logs.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            confidence = p[np.arange(n), best]
            words = batch.column("has_words").to_numpy(zero_copy_only=False)
            by_text = pa.array(likelihood.argmax(axis=1), mask=~words)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), names.take(pa.array(best)), pa.array(confidence), names.take(by_text), batch.column("declared"), pa.array(words), pa.array(words & (confidence >= MIN_CONFIDENCE))],
                                             [*keep, "language", "confidence", "text_language", "declared", "has_words", "kept"])

    schema = schema_with(told.select(*keep), "language string, confidence double, text_language string, declared string, has_words boolean, kept boolean")
    return met.select(*keep, "declared", "has_words", "likelihood", "share", "host_counts", "suffix_counts").mapInArrow(fuse, schema)


def document_records(docs: DataFrame) -> DataFrame:
    """Documents: the lang column is the declared language, the source the address."""
    return docs.select(F.col("doc_id").cast("string").alias("key"), "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("address"))


def page_records(pages: DataFrame) -> DataFrame:
    """Pages: text without markup, the html element's lang attribute, the URL."""
    html = F.col("html")
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"&#?[A-Za-z0-9]{1,10};", " ")
    attribute = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,8})""", 1)
    return pages.select(F.col("page_id").cast("string").alias("key"), "page_id", text.alias("text"), F.when(attribute != "", attribute).alias("declared"), F.col("url").alias("address"))


def identify_all(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of all documents and pages, with priors from both."""
    d, p = document_records(docs), page_records(pages)
    both = d.withColumn("page_id", F.lit(None).cast(p.schema["page_id"].dataType)).unionByName(p.withColumn("doc_id", F.lit(None).cast(d.schema["doc_id"].dataType)))
    return identify(both, ("doc_id", "page_id"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is identified, with their columns."""
    hashed = F.xxhash64("text")
    found = identify(document_records(docs).withColumn("text_hash", hashed), ("doc_id", "text_hash"))
    gone = materialize(found.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "language-rejects")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (hashed == gone["_hash"]), "left_anti")
