import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from loanmart.llm import queries
from loanmart.llm.attention import SPAN, WIDTH, Layout, Model, chunks_of, initial, shapes
from loanmart.llm.bpe import vocabulary
from loanmart.llm.lm_scoring import _train_round, encode_words, planes, score_documents, values_of
from tests.conftest import SF_MID

PATH = queries.tokenizer_path()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\0end"]


def check(rows, docs):
    """Counts and base scores against plain counting."""
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in docs}
    counts = Counter(w for i, t in docs if not held[i] for w in words(t))
    n = sum(counts.values())
    base = n + 0.1 * (len(counts) + 1)
    want = sorted((str(i), held[i], len(words(t)), sum(w in counts for w in words(t)), n, round(sum(math.log10((counts.get(w, 0) + 0.1) / base) for w in words(t)), 5)) for i, t in docs)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want


def test_query_against_plain_counts(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op1_lm_scoring"](spark, SF_MID).collect()
    check(rows, docs)
    assert all(r.score < 0 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "One two"), (3, "One two"), (None, "one"), (4, "y " * 30_000), (5, "x" * 5000), (6, "<|endoftext|> 日本")]
    rows = score_documents(spark.createDataFrame([(*d, 0.0) for d in docs], "doc_id long, text string, score double"), PATH).collect()
    check(rows, docs)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert score_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    only_held = score_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), PATH).collect()
    assert only_held[0].train_tokens == 0 and only_held[0].base_score == 0 and math.isfinite(only_held[0].score)


def small():
    rng = np.random.default_rng(0)
    vocab = vocabulary(PATH)
    counts = np.zeros(vocab.size)
    counts[:4000] = rng.integers(1, 1000, 4000)
    layout = Layout(counts, vocab.bytes_of, 50256)
    return layout, Model((initial(layout) + rng.normal(0, 0.05, len(initial(layout)))).astype(np.float32), layout)


def test_every_position_is_scored_once_with_its_own_context():
    layout, model = small()
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 5000, n) for n in (0, 1, 15, 16, 17, 70)]
    ids, bounds = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows, before, has, target, real, place, ends = chunks_of(ids, bounds, layout, 50256)
    logs = model.id_logs(rows, has, target)
    assert real.sum() == len(ids) + len(texts) and (target[place] == ids).all() and (target[ends] == 50256).all()
    # one position at a time: the inputs of the last SPAN positions, nothing else
    p = model.p
    for t, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        given = layout.row[np.concatenate([[50256], ids[a:b]])]
        own = np.concatenate([place[a:b], [ends[t]]])
        for k in range(len(given)):
            x = p["E"][given[max(0, k - SPAN + 1) : k + 1]]
            s = (x[-1] @ p["Wq"]) @ (x @ p["Wk"]).T * WIDTH**-0.5 + p["rel"][np.arange(len(x))[::-1]]
            w = np.exp(s - s.max())
            h = np.tanh(x[-1] @ p["W"] + (w / w.sum()) @ (x @ p["Wv"]) @ p["Wo"])
            z, i = h @ p["U"] + p["b"], target[own[k]]
            want = z[layout.kind[i]] - np.log(np.exp(z).sum())
            if layout.kind[i] < 64:
                m = h @ p["M"][layout.kind[i]] + p["c"][layout.kind[i]]
                want += m[layout.member[i]] - np.log(np.exp(m).sum())
            else:
                want += layout.share_log[i]
            assert abs(want - logs[own[k]]) < 1e-3


def test_all_ids_have_probability_one_together():
    layout, model = small()
    n = len(layout.row)
    total = 0.0
    chunk = np.zeros((1, SPAN), np.int32)
    for k in range(0, n, 2048):
        ids = np.arange(k, min(k + 2048, n))
        rows = np.repeat(chunk, len(ids) + 1, axis=0)
        target = np.zeros(len(ids) * SPAN, np.int64)
        target[SPAN - 1 :: SPAN] = ids
        total += np.exp(model.id_logs(rows, np.ones(len(ids), bool), target)[SPAN - 1 :: SPAN].astype(float)).sum()
    assert abs(total - 1) < 1e-3


def test_gradients():
    layout, model = small()
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5000, 60)
    rows, before, has, target, real, _, _ = chunks_of(ids, np.array([0, 25, 60]), layout, 50256)
    loss = lambda m: -m.id_logs(rows, has, target)[real].mean(dtype=float)
    flat, state = model.flat.copy(), np.zeros_like(model.flat)
    model.step(rows, before, has, target, real, state)
    got, at = np.sqrt(state), 0  # after one step the state is the squared gradient
    for name, shape in shapes(layout):
        size = int(np.prod(shape))
        for k in np.argsort(-got[at : at + size])[:3] + at:
            up, down = flat.copy(), flat.copy()
            up[k] += 1e-2
            down[k] -= 1e-2
            slope = (loss(Model(up, layout)) - loss(Model(down, layout))) / 2e-2
            assert abs(abs(slope) - got[k]) < 2e-3 + 0.05 * got[k], name
        at += size


def test_all_words_of_a_long_text_train(spark):
    vocab = vocabulary(PATH)
    seen = [k for k in range(vocab.size) if re.fullmatch(rb" [a-z]{3,}", vocab.bytes_of[k])][:900]
    counts = np.zeros(vocab.size)
    counts[seen] = 10
    layout = Layout(counts, vocab.bytes_of, 50256)
    text = " ".join(vocab.bytes_of[k].decode().strip() for k in seen for _ in range(8))
    flat = initial(layout)
    _, state = _train_round(spark.createDataFrame([(text,)], "text string"), PATH, layout, flat, np.full_like(flat, 1e-10), 50256)
    learnt = state[: layout.n_rows * WIDTH].reshape(-1, WIDTH).max(axis=1) > 1.5e-10
    assert learnt[layout.row[seen]].all()


def test_tail_classes_tell_first_letters_apart():
    layout, _ = small()
    bytes_of = vocabulary(PATH).bytes_of
    tail = [k for k in range(4000, 50000) if layout.kind[k] >= 64]
    firsts = {}
    for k in tail:
        b = bytes_of[k].lower()
        if re.match(rb" ?[a-z]", b):
            firsts.setdefault(int(layout.kind[k]), set()).add(b[:2] if b[:1] == b" " else b[:1])
    assert len(firsts) == 52 and all(len(x) == 1 for x in firsts.values())


def test_a_small_block_is_passed_once(spark):
    layout, _ = small()
    flat = initial(layout)
    start = np.full_like(flat, 1e-6)
    weights, state = _train_round(spark.createDataFrame([("one two three four five",)], "text string"), PATH, layout, flat, start, 50256)
    vocab = vocabulary(PATH).bytes_of
    ids = np.array([vocab.index(w) for w in (b" one", b" two", b" three", b" four", b" five")])
    rows, before, has, target, real, _, _ = chunks_of(ids, np.array([0, 5]), layout, 50256)
    want, squares = flat.copy(), start.copy()
    Model(want, layout).step(rows, before, has, target, real, squares)
    assert np.allclose(weights, want, atol=1e-6) and np.allclose(state, squares, rtol=1e-4, atol=1e-12)


def test_windows_share_counts_and_each_document_is_encoded_once(spark):
    docs = [(i, " ".join(f"w{(i * k) % 97}" for k in range(1, 60))) for i in range(80)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumns({"held_out": F.lit(False), "turn": F.lit(0)})
    told = encode_words(rows, PATH).cache()
    assert told.where("kind = 0").select("window").distinct().count() > 1
    words = told.where("kind = 1")
    assert words.count() == words.select("window", "word").distinct().count()
    place = {(r.window, r.place): (r.word, np.frombuffer(r.ids, np.uint16).tolist()) for r in words.collect()}
    hashes = {}
    for r in told.where("kind = 0").collect():
        text = docs[r.doc_id][1].split()
        own = [place[r.window, p] for p in values_of(np.frombuffer(r.words, np.uint8), np.array([0, len(r.words)]), np.int32).tolist()]
        assert np.frombuffer(r.ids, np.uint16).tolist() == [i for _, ids in own for i in ids]
        for w, (h, _) in zip(text, own, strict=True):
            assert hashes.setdefault(w, h) == h
    counts = {r.word: r.n for r in words.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    assert {w: counts[h] for w, h in hashes.items()} == Counter(w for _, t in docs for w in t.split())
    check(score_documents(rows.select("doc_id", "text"), PATH).collect(), docs)


def test_runs_of_values_come_back():
    values, bounds = np.arange(300_000, dtype=np.uint32)[::3], np.array([0, 0, 7, 99_000, 100_000])
    column = planes(values, bounds)
    data, offsets = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)
    assert (offsets == bounds * 4).all() and (values_of(data, offsets, np.uint32) == values).all()
