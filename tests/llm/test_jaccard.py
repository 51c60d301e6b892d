import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from loanmart.llm import jaccard, queries
from loanmart.llm.jaccard import components, jaccard_components, keep_one, near_pairs, parity_bitmap
from tests.conftest import SF_MID, SF_SMALL


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].add(k)
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for m in set().union(*(holders[x] for x in s)) if s else ():
            if m < k and 100 * len(s & sets[m]) >= 75 * len(s | sets[m]):
                parent[find(k)] = find(m)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(docs, sets))), key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op5_jaccard"](spark, sf).collect()), key=str)
    assert got == brute(docs)


def near_texts(seed, n, base_words=60):
    """Families of edited copies around the threshold, shared passages, short and odd texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4)))
    passage = [word() for _ in range(30)]
    docs = []
    while len(docs) < n:
        base = [word() for _ in range(rnd.randint(1, base_words))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice([1, 2, 3, 8])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 20))):
                w[rnd.randrange(len(w))] = word()
            docs.append((len(docs), " ".join(w)))
    docs += [(n + 50, None), (n + 51, ""), (n + 52, "   "), (n + 53, "a"), (n + 54, "A"), (n + 55, "a b c d"), (n + 56, "x y " * 30_000), (n + 57, "x y " * 20_000), (0, docs[3][1]), (None, docs[5][1]), docs[7], docs[7]]
    rnd.shuffle(docs)
    return docs


def test_families_against_brute_force(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        docs = near_texts(3, 300)
        df = spark.createDataFrame([(*d, 1, "q") for d in docs], "doc_id long, text string, key int, n_shingles string").repartition(3)
        assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_regions_split_and_recurse(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 40)
    rnd = random.Random(9)
    shared = [f"s{k}" for k in range(40)]
    docs = []
    for k in range(260):  # sets that share a passage but are not near, and some that are
        own = [f"w{rnd.randrange(10**6)}" for _ in range(12)] if k % 3 else [f"v{k // 30}x{m}" for m in range(12)]
        own[rnd.randrange(12)] = f"z{k}"
        docs.append((k, " ".join(shared + own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(docs)


def test_later_rounds_hold_large_regions_only(spark, monkeypatch):
    held = []
    written = jaccard.materialize

    def noted(df, name="stage"):
        held.append((name, written(df, name)))
        return held[-1][1]

    monkeypatch.setattr(jaccard, "materialize", noted)
    monkeypatch.setattr(jaccard, "SMALL_REGION", 4)
    docs = near_texts(11, 200, 40)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(docs)
    first, *later = [df for name, df in held if name == "jaccard-mixed"]
    assert first.where("members <= 4").count() and first.where("members > 4").count()
    assert later and not any(df.where("members <= 4").count() for df in later)


def test_keep_one_and_empty(spark):
    docs = near_texts(5, 120)
    df = spark.createDataFrame([(i, t, "en", i) for i, t in docs], "doc_id long, text string, lang string, key long")
    kept = keep_one(df).collect()
    want = brute(docs)
    groups = {c for _, n, c in want if n and c is not None}
    words = sorted({r.doc_id for r in kept if r.text and r.text.split() and r.doc_id is not None})
    assert set(words) == groups and df.columns == keep_one(df).columns
    assert sum(1 for r in kept if not (r.text or "").split()) == sum(1 for _, n, _ in want if not n)
    assert jaccard_components(df.limit(0)).collect() == [] and keep_one(df.limit(0)).collect() == []


def test_keep_one_of_repeated_rows(spark):
    text = lambda c: " ".join(f"{c}{k}" for k in range(12))
    docs = [(7, text("a"), "b"), (7, text("a"), "a"), (7, text("a"), "b"), (8, text("a"), "a"), (None, text("a"), "a")]
    docs += [(None, text("n"), "x")] * 30 + [(None, text("m"), "x")] * 3 + [(9, text("m"), "x")]
    docs += [(None, text("o"), "x")] * 2 + [(None, text("o").upper(), "x")] * 2
    docs += [(5, "", "x")] * 2 + [(None, None, "x")] * 3
    kept = keep_one(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)).collect()
    got = sorted((str(r.doc_id), (r.text or "").lower(), r.lang) for r in kept)
    assert got == sorted([("7", text("a"), "a"), ("None", text("n"), "x"), ("9", text("m"), "x"), ("None", text("o"), "x"), *[("5", "", "x")] * 2, *[("None", "", "x")] * 3])


def test_voronoi_cells_lose_no_pair():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, 120, dtype=np.uint64)
        for _ in range(10):
            s = base.copy()
            s[: rng.integers(0, 25)] = rng.integers(0, 2**63, 1, dtype=np.uint64)
            sets.append(np.unique(s))
    size = np.array([len(s) for s in sets])
    bits = np.stack([np.frombuffer(parity_bitmap(np.resize(s, 120)) if len(s) > 128 else parity_bitmap(s).ljust(32, b"\0")[:32], np.uint64) for s in sets])
    keep = np.array([len(parity_bitmap(s)) == 32 for s in sets])
    index = np.flatnonzero(keep)
    got = {tuple(sorted(p)) for x in near_pairs(bits, size, lambda a, b: np.ones(len(a), bool), index) for p in x.tolist()}
    want = {(a, b) for k, a in enumerate(index.tolist()) for b in index[k + 1 :].tolist() if 4 * len(np.intersect1d(sets[a], sets[b])) >= 3 * len(np.union1d(sets[a], sets[b]))}
    assert want and want <= got


def test_components_of_a_chain(spark):
    n = 60
    rnd = random.Random(4)
    names = rnd.sample(range(1000), n)
    edges = [(names[k], names[k + 1]) for k in range(n - 1)] + [(2000, 2001), (2001, 2000), (3000, 3000)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: min(names) for x in names} | {2000: 2000, 2001: 2000}


def test_small_regions_give_only_pairs_that_may_be_linked():
    """Members that share one shingle and little else give no pairs, whatever their number."""
    rng = np.random.default_rng(4)

    def made(n_regions):
        cols = {c: [] for c in ("shingle", "key", "component", "n", "place", "sketch")}
        near = set()
        for s in range(n_regions):
            base = rng.integers(0, 2**63, 400, dtype=np.uint64)
            for m in range(8):  # the first two are near
                own = np.concatenate([base[:360], rng.integers(0, 2**63, 40, dtype=np.uint64)]) if m < 2 else rng.integers(0, 2**63, 400 - m, dtype=np.uint64)
                for c, v in zip(cols, (s, 8 * s + m, 8 * s + m, len(own), 0, jaccard.parity_bitmap(own))):
                    cols[c].append(v)
            near.add((8 * s, 8 * s + 1))
        batch = pa.RecordBatch.from_pydict(cols)
        sets = pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), batch.column("sketch")], ["key", "n_shingles", "bitmap"])
        sketch = next(iter(jaccard.sketches([sets]))).column("sketch")
        assert all(len(x.as_py()) == 64 for x in sketch)
        return pa.RecordBatch.from_arrays([*batch.columns[:5], sketch], batch.schema.names), near

    batch, near = made(30)
    for cuts in ([0, 240], [0, 3, 100, 101, 240]):
        out = [x for b in jaccard.small_region_pairs(batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])) for x in zip(*(b.column(c).to_pylist() for c in "ab"))]
        assert sorted(out) == sorted(near)


def test_sketches_never_part_linked_sets():
    rng = np.random.default_rng(5)
    for n in (1, 3, 7, 20, 64, 85, 86, 130, 341, 342, 700, 1400):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[: n - n // 7], rng.integers(0, 2**63, n // 7, dtype=np.uint64)])
        c = np.concatenate([a, rng.integers(0, 2**63, n // 3, dtype=np.uint64)])
        sets = pa.RecordBatch.from_pydict({"key": [1, 2, 3], "n_shingles": [len(a), len(b), len(c)], "bitmap": [jaccard.parity_bitmap(x) for x in (a, b, c)]})
        sketch = next(iter(jaccard.sketches([sets]))).column("sketch")
        d = jaccard.bit_distances(sketch, np.array([0, 0]), np.array([1, 2]))
        for x, y, far in ((a, b, d[0]), (a, c, d[1])):
            both = len(np.intersect1d(x, y))
            assert 4 * both < 3 * (len(x) + len(y) - both) or 7 * far <= len(x) + len(y)


def test_pairs_that_cannot_be_linked_leave_their_region(spark):
    rows = [(1, 10, 40, 0), (1, 11, 40, 10), (2, 20, 40, 8), (2, 21, 40, 4), (3, 30, 40, 0), (3, 31, 29, 0), (4, 40, 40, 9), (4, 41, 40, 9), (4, 42, 40, 9)]
    members = spark.createDataFrame(rows, "shingle long, key long, n int, place int")
    labels = spark.createDataFrame([], "key long, component long")
    left = jaccard.mixed_regions(members, labels).select("shingle").distinct().collect()
    assert sorted(r[0] for r in left) == [1, 4]  # 2: places too far on, 3: sizes too unlike
