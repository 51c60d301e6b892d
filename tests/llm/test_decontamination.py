import hashlib
import random
import re

import numpy as np
import pytest

from loanmart.llm import queries
from loanmart.llm.decontamination import FMIndex, cut, report, scan, suffix_array
from tests.conftest import SF_MID, SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).update([] if i is None else [str(i)])
    lengths = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for n in lengths:
                if (own := windows.get(tuple(w[k : k + n]))) is not None and k + n <= len(w):
                    hit.update(range(k, k + n))
                    found |= own
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op2_decontamination"](spark, sf).collect()), key=str)
    assert got == brute(docs, items)
    assert any(r[-1] for r in got)


def test_edge_rows(spark):
    rnd = random.Random(5)
    vocab = ["a", "b", "éa", "7"]
    items = [(1, "a b"), (2, "a"), (3, None), (4, "!!"), (4, "b b b"), (5, " ".join(rnd.choice(vocab) for _ in range(14))), (5, None), (None, "éa éa"), (6, "A B")]
    docs = [(k, " ".join(rnd.choice([*vocab, "zz"]) for _ in range(rnd.randint(0, 40)))) for k in range(60)]
    docs += [(1, items[5][1] + " " + items[5][1]), (1, items[5][1] + " " + items[5][1]), (None, "a-b"), (90, None), (91, ""), (92, "x " * 30_000 + items[5][1])]
    d = spark.createDataFrame([(*r, "q", "w") for r in docs], "doc_id long, text string, n_hit string, _text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, [x for x in items if x[1]])
    # the item without an id hits words, but is in no list
    assert any(r[2] > 0 and r[3] == 0 for r in want)
    assert sorted(map(tuple, report(d, b).collect()), key=str) == want
    assert report(d.limit(0), b).collect() == []
    assert {r.n_hit for r in report(d, b.limit(0)).collect()} == {0}


def test_cut_takes_the_spans_and_nothing_else(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Vorher Wörter, {item.upper()}! Nachher.", 9), (2, item, 9), (3, "nothing of it", 13), (4, None, None), (5, f"{item} {item} tail", 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_chars int")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r for r in cut(d, b).collect()}
    assert set(out) == {1, 3, 4, 5}
    assert out[1].text == "Vorher Wörter, \n! Nachher." and out[1].n_chars == len(out[1].text)
    assert out[3].text == "nothing of it" and out[3].n_chars == 13 and out[4].text is None
    assert out[5].text == "\n tail"
    assert not any(r.n_hit for r in scan(cut(d, b), b).collect())


def test_cut_takes_repeats_odd_rows_and_clashing_names(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"a {item} b", "x"), (1, f"a {item} b", "y"), (1, "other", "z"), (None, f"c {item}", "x"), (None, f"c {item}", "x"), (None, None, "x"), (2, "", "x"), (2, item, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, _hash string").repartition(3)
    b = spark.createDataFrame([(None, item.upper())], "item_id long, text string")
    got = sorted(map(tuple, cut(d, b).collect()), key=str)
    assert got == sorted([(1, "a \n b", "x"), (1, "a \n b", "y"), (1, "other", "z"), (None, "c \n", "x"), (None, "c \n", "x"), (None, None, "x"), (2, "", "x")], key=str)
    assert cut(d, b).columns == d.columns


def test_blocks_count_words_of_capitals(spark, monkeypatch):
    from loanmart.llm import decontamination
    monkeypatch.setattr(decontamination, "PHRASE_WORDS", 12)
    items = [(k, f"ITEM NUMBER {chr(65 + k)} HAS EXACTLY EIGHT WORDS NOW") for k in range(6)]
    b = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontamination.phrase_blocks(b, 10, "item_id", "text")) == 3
    docs = [(k, t.lower()) for k, t in items]
    got = report(spark.createDataFrame(docs, "doc_id long, text string"), b)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 30, 12)
        runs = rng.integers(1, 4, int(lengths.sum()))
        index = FMIndex(runs, lengths, 3)
        text, at = [], 0
        for n in lengths:
            text += [*runs[at : at + n].tolist(), 0]
            at += n
        for size in (1, 2, 4):
            phrase = rng.integers(1, 4, size)
            lo, hi = index.search(np.concatenate([np.zeros(4 - size, np.int64), phrase])[None, :])
            got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
            assert got == [k for k in range(len(text)) if text[k : k + size] == phrase.tolist()]
    s = rng.integers(0, 2, 60)
    assert suffix_array(s).tolist() == sorted(range(60), key=lambda k: s[k:].tolist())
