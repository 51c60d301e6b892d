"""Toxicity, quality and language: held-out accuracy, learning rules, odd rows."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loanmart.llm import language, quality, queries
from loanmart.llm.language import identify, keep_identified
from loanmart.llm.quality import cumulative_link, grade_documents, keep_selected
from loanmart.llm.toxicity import ftrl, score_documents
from tests.conftest import SF_MID

ODD = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "word"), (4, "x " * 60_000), (5, "\x00 \t")]
LABELS = "doc_id long, quality int, toxic int"


def held(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n == 1


def test_toxicity_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_toxicity"](spark, SF_MID).collect()}
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    assert all(r.held_out == held(i, 3) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    out = [(rows[x.doc_id].score, x.toxic) for x in labels if held(x.doc_id, 3)]
    good, bad = [s for s, t in out if not t], [s for s, t in out if t]
    assert np.mean([a > b for a in bad for b in good]) > 0.75 and np.mean(np.array(good) >= 0.7) < 0.03


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} {'vile' if i % 4 == 0 else 'fine'} text") for i in range(120)], "doc_id long, text string")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(120)]
    flipped = [(i, q, 1 - t if held(i, 3) else t) for i, q, t in labels]
    a, b = (sorted(map(tuple, score_documents(docs, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, flipped))
    assert a == b and all((s > 0.5) == (i % 4 == 0) for i, _, s, _ in a)


def test_ftrl_keeps_few_weights():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.append(rng.integers(10, 4000, 60), [1] if k % 5 == 0 else [2])) for k in range(600)]
    feature, weight, _ = ftrl(rows, np.array([float(k % 5 == 0) for k in range(600)]))
    w = dict(zip(feature.tolist(), weight))
    assert w[1] > 0 and w.get(2, 0) <= 0 and len(w) < 1000


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, SF_MID).collect()}
    labels = [x for x in spark.read.parquet(f"{SF_MID}/labels.parquet").collect() if held(x.doc_id, 5)]
    assert all(rows[x.doc_id].selected for x in labels if x.quality)
    assert np.mean([not rows[x.doc_id].selected for x in labels if not x.quality]) > 0.6
    assert all(0 <= r.expected_grade <= 2 and r.selected == (r.tail_probability >= 0.5) for r in rows.values())


def test_cumulative_link_orders_its_thresholds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=900)
    y = np.digitize(x + 0.2 * rng.normal(size=900), [-0.7, 0.1, 0.9])
    w, theta = cumulative_link((np.repeat(np.arange(900), 1), np.zeros(900, np.int64), x), y, 4)
    assert (np.diff(theta) > 0).all() and w[0] > 1
    assert np.mean(np.abs((w[0] * x[:, None] > theta[None, :]).sum(axis=1) - y) <= 1) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 0.5, True) for r in ODD], "doc_id long, text string, score double, selected boolean")
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1), (4, None, None), (2, 0, 0)], LABELS)
    for labels in (none, some):
        assert score_documents(docs, labels).count() == grade_documents(docs, labels).count() == len(ODD)
        kept = keep_selected(docs, labels)
        assert kept.columns == docs.columns
        assert score_documents(docs.limit(0), labels).count() == keep_selected(docs.limit(0), labels).count() == 0
    assert keep_selected(docs, none).count() == len(ODD)


def test_keeping_selected_rows_joins_nothing(spark, capsys):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    kept = keep_selected(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"))
    assert 0 < kept.count() < docs.count()
    capsys.readouterr()
    kept.explain()
    plan = capsys.readouterr().out
    assert "ArrowEvalPython" in plan and "Join" not in plan and "Exchange" not in plan


def test_grading_a_batch_takes_little_memory():
    rng = np.random.default_rng(0)
    texts = pa.array([" ".join(map(str, rng.integers(0, 10**6, 3000).tolist())) for _ in range(400)])  # 8 MB
    model = rng.normal(size=1 << quality.BITS).astype(np.float32), np.array([0.0]), np.array([0.0, 1.0])
    tracemalloc.start()
    try:
        tails = np.concatenate([part[3] for part in quality._graded(texts, model, 1)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200 << 20 and len(tails) == 400
    alone = [next(quality._graded(texts.slice(k, 1), model, 1))[3][0] for k in (0, 57, 399)]
    assert np.allclose(alone, tails[[0, 57, 399]])


def test_language_of_held_texts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    # a few documents declare a wrong language, come from odd sources, or declare none
    rows = [(str(d.doc_id), d.text, {0: "fr", 1: None, 2: "xx"}.get(d.doc_id % 50, d.lang), None if d.doc_id % 11 == 0 else d.source, d.lang) for d in docs]
    out = identify(spark.createDataFrame(rows, "key string, text string, declared string, address string, truth string"), ("key", "truth")).collect()
    assert len(out) == len(rows) and np.mean([r.language == r.truth for r in out]) > 0.99 and all(r.kept for r in out)


def test_rare_language_in_a_large_table(spark):
    schema = "key string, text string, declared string, address string"
    rows = [(f"e{k}", f"the house and garden {k % 90}", "en", None) for k in range(26_000)]
    rows += [(f"q{k}", f"qvex jurpo zimt wolux {k}", "qq", None) for k in range(24)] + [("z", "qvex jurpo zimt wolux", None, None)]
    out = {r.key: r for r in identify(spark.createDataFrame(rows, schema).repartition(4), ("key",)).where("key like 'q%' or key = 'z'").collect()}
    assert len(out) == 25 and all(r.text_language == "qq" for r in out.values())
    assert all(out[f"q{k}"].language == "qq" and out[f"q{k}"].kept for k in range(24))


@pytest.mark.parametrize("others", [20, 100_000])
def test_a_language_of_one_row_is_known_at_any_size(spark, others):
    schema = "key string, text string, declared string, address string"
    n = others // 20
    rows = [(f"e{k}", f"the house and garden {k}", "en", None) for k in range(n)] + [(f"d{k}", f"das haus und der garten {k}", "de", None) for k in range(others - n)]
    rows += [("q", "qvex jurpo zimt wolux plint", "qq", None), ("z", "jurpo wolux zimt", None, None), ("u", "xyzzy plugh", "en", None)]
    out = {r.key: r for r in identify(spark.createDataFrame(rows, schema).repartition(4), ("key",)).where("key in ('q', 'z', 'u', 'e0', 'd0')").collect()}
    assert out["q"].language == out["z"].language == out["z"].text_language == "qq" and out["q"].kept
    # words that no language has seen do not speak for the rare one
    assert out["u"].language == out["e0"].language == "en" and out["d0"].language == "de"


def test_repeated_ids_learn_from_one_text(spark):
    rows = [(k, f"{'good fine text here' if k % 2 else 'bad junk junk spam'} {k}", k % 2) for k in range(60)]
    docs = [(k, t) for k, t, _ in rows] + [(k, f"another {t}") for k, t, _ in rows]
    labels = spark.createDataFrame([(k, y, 1 - y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    one, two = (spark.createDataFrame(docs[::step], "doc_id long, text string").repartition(parts) for step, parts in ((1, 2), (-1, 5)))
    for run in (grade_documents, score_documents):
        assert sorted(map(tuple, run(one, labels).collect())) == sorted(map(tuple, run(two, labels).collect()))


def test_more_languages_than_a_block(spark):
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(70)]
    rows = [(f"{x}{k}", f"{x}vor {x}lum {x}qis {x}dan {k}", x, None, x) for x in names for k in range(25)]
    out = identify(spark.createDataFrame(rows, "key string, text string, declared string, address string, truth string"), ("key", "truth")).collect()
    assert len(out) == len(rows) and all(r.language == r.truth == r.text_language and r.kept for r in out)


def test_addresses_decide_short_texts(spark):
    words = {"en": "the house and garden of that man", "de": "das haus und der garten von dem mann"}
    rows = [(f"{l}{k}", words[l], l, f"http://www{k % 5}.example.{'uk' if l == 'en' else 'de'}/p") for l in words for k in range(60)]
    rows += [("a", "zz", None, "http://www1.example.uk/q"), ("b", "zz", None, "http://other.de/q"), ("c", None, None, None), ("d", "", "de", "http://x.de")]
    out = {r.key: r for r in identify(spark.createDataFrame(rows, "key string, text string, declared string, address string"), ("key",)).collect()}
    assert out["a"].language == "en" and out["b"].language == "de"
    assert not out["c"].kept and not out["d"].kept and out["d"].language == "de"


def test_keep_identified_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "en" if k % 2 else None, None, k) for k, r in enumerate(ODD)], "doc_id long, text string, lang string, source string, _id int")
    assert keep_identified(docs).columns == docs.columns
    assert {r.text for r in keep_identified(docs).collect()} <= {"word", "x " * 60_000}
    assert keep_identified(docs.limit(0)).count() == 0


def test_language_features_of_many_texts_take_bounded_memory():
    rng = np.random.default_rng(7)
    texts = pa.array(["".join(map(chr, rng.choice([32, *range(97, 123)], 4096))) for _ in range(1024)])
    tracemalloc.start()
    rows = sum(hi - lo for lo, hi, _, _ in language.feature_blocks(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1024 and peak < 150 << 20
