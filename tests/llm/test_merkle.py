"""The manifest against a plain tree in Python, and the cases that its docstring defines."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from loanmart.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, path string, group string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, more=0):
    values = (r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, by lists."""

    def levels(hs):
        out = [hs]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
        return out

    def way(tree, i):
        for level in tree[:-1]:
            first = i - i % fanout
            yield "".join(level[first:i]), "".join(level[i + 1:first + fanout])
            i //= fanout

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in keys:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {g: levels([leaf_of(r) for r in groups[g]]) for g in keys}
    trunk = levels([trees[g][-1][0] for g in keys])
    out = []
    for k, g in enumerate(keys):
        for i, r in enumerate(groups[g]):
            siblings = [*way(trees[g], i), *way(trunk, k)]
            h = leaf_of(r, 1 if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 else 0)
            for left, right in siblings:
                h = sha(left + h + right)
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], trunk[-1][0], sha("".join(a + b for a, b in siblings)), h, h == trunk[-1][0]))
    return sorted(out, key=str)


def build(rows, spark, **how):
    """Rows with clashing extra columns, in several partitions."""
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in merkle.tampered_manifest(df, **how).collect()), key=str)


def doc(i, lang="en", text="some text", source="s", n_chars=9):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


@pytest.mark.parametrize("fanout,levels", [(2, 4), (2, 1), (3, 2), (4, 1)])
def test_trees_of_all_shapes(spark, fanout, levels):
    rows = [doc(i, f"l{g}", f"text {i}", n_chars=i) for g, n in enumerate((1, 2, 3, 5, 16, 17, 33, 40)) for i in range(100 * g, 100 * g + n)]
    assert build(rows, spark, fanout=fanout, levels=levels) == plain(rows, fanout)


def test_odd_rows(spark):
    rows = [doc(1, None), doc(2, ""), doc(3, "é"), doc(4, "z"), doc(5, "Z"), doc(None, "en"), doc(None, "en", "other"), doc(6, text=None, source=None, n_chars=None),
            doc(6, text=None, source=None, n_chars=None), doc(6, text=""), doc(7, text="ü" * 200_000, n_chars=2**63 - 1), doc(-9, n_chars=-1)] + [doc(k, n_chars=None if k % 2 else 3) for k in range(20, 60)]
    got = build(rows, spark)
    assert got == plain(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows) / 2


def test_small_tables(spark):
    assert build([], spark) == []
    assert build([doc(3)], spark) == plain([doc(3)])
    assert build([doc(3, "a"), doc(4, "b")], spark) == plain([doc(3, "a"), doc(4, "b")])


def test_tampering_is_found(spark):
    rows = [doc(i, f"l{i % 2}", n_chars=i) for i in range(60)]
    bad = {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}
    got = build(rows, spark)
    assert {r[0] for r in got if not r[-1]} == bad and len({r[3] for r in got}) == 1


def test_ranked_splits_a_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4900, "hot").otherwise("cold").alias("group"), (F.col("id") * 7919 % 5000).alias("k"))
    got = merkle.ranked(rows, "group", ["k"]).collect()
    for g in ("hot", "cold"):
        own = sorted((r for r in got if r["group"] == g), key=lambda r: r.k)
        assert [r.place for r in own] == list(range(len(own))) and {r.n for r in own} == {len(own)}
