import hashlib

import pyarrow as pa

from loanmart.llm import queries
from loanmart.llm.fingerprints import Prints, chunk_ends, edited_fingerprints, fingerprint, likeness, parse_fingerprint
from tests.conftest import SF_SMALL


def brute(texts):
    """Edited texts and prints, one text at a time."""
    out = []
    for i, t in enumerate(texts):
        u = texts[(i + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        p, e, n = (Prints(pa.array([x])) for x in (t, edited, u))
        out.append((len(t), hashlib.sha256(edited.encode()).hexdigest(), p.text(0), e.text(0), likeness(p.row(0), e.row(0)), likeness(p.row(0), n.row(0))))
    return out


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = sorted((r.doc_id, r.text) for r in docs)
    want = dict(zip([d for d, _ in docs], brute([t for _, t in docs])))
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op3_fingerprints"](spark, SF_SMALL).collect()}
    assert got == want


def test_edge_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, "é" * 41 + "x", 3), (1, "ab", 4), (1, "ab", 4), (7, "word " * 40_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    texts = [t or "" for _, t, _ in sorted(rows, key=lambda r: r[0])]
    got = sorted((r.doc_id, *tuple(r)[1:]) for r in edited_fingerprints(df).collect())
    want = sorted((i, *b) for i, b in zip(sorted(r[0] for r in rows), brute(texts)))
    assert got == want
    assert edited_fingerprints(df.limit(0)).collect() == []
    one = edited_fingerprints(spark.createDataFrame([(4, "some words of one text only")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint(df).count() == len(rows)


def test_chunks_survive_a_shift():
    import random

    rnd = random.Random(3)
    text = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(800))
    a, b = (Prints(pa.array([x])).row(0) for x in (text, "a new start, " + text))
    assert likeness(a, b) > 0.97
    assert (parse_fingerprint(Prints(pa.array([text])).text(0)) == a).all()


def test_a_row_does_not_depend_on_its_neighbours():
    texts = ["alpha beta gamma " * 20, "x" * 300, "", "delta epsilon " * 30]
    together = Prints(pa.array(texts))
    for i, t in enumerate(texts):
        assert (Prints(pa.array([t])).row(0) == together.row(i)).all() if t else not len(together.row(i))
    import numpy as np

    ends, counts = chunk_ends(np.frombuffer(("y" * 500).encode(), np.uint8), np.array([0, 500]))
    assert ends[-1] == 500 and counts.tolist() == [len(ends)]


def test_the_plan_does_not_grow_with_the_runs(spark):
    from pyspark.sql import functions as F

    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of document "), "id").alias("text"))
    plan = lambda: len(edited_fingerprints(df)._jdf.queryExecution().analyzed().toString())
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    few = plan()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        assert plan() < 2 * few
        got = {r.doc_id: tuple(r)[1:] for r in edited_fingerprints(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert got == dict(enumerate(brute([f"text of document {i}" for i in range(400)])))
