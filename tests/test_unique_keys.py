"""Uniqueness over arriving batches: equal to grouping everything, reading only what is doubtful."""

import random

from pyspark.sql import functions as F

from loanmart.operators import unique_keys as U
from loanmart.session import scratch_path

SCHEMA = "a long, b string, v int"


def run(spark, batches, **how):
    """Violations after each batch, and the batches that were read again for it."""
    check, read, out = U.UniqueKeys(spark, scratch_path(spark, "unique"), ["a", "b"], buckets=2, **how), [], []
    dfs = {f"b{k}": spark.createDataFrame(rows, SCHEMA) for k, rows in enumerate(batches)}

    def older(names):
        read.append(list(names))
        whole = None
        for n in names:
            whole = dfs[n] if whole is None else whole.unionByName(dfs[n])
        return whole

    for name, df in dfs.items():
        read.clear()
        got = sorted((tuple(r) for r in check.check(df, name, older).collect()), key=str)
        out.append((got, [list(r) for r in read]))
    return check, dfs, older, out


def plain(batches):
    seen, out = {}, []
    for rows in batches:
        for a, b, _ in rows:
            seen[a, b] = seen.get((a, b), 0) + 1
        out.append(sorted(((a, b, seen[a, b]) for a, b in {r[:2] for r in rows} if seen[a, b] > 1), key=str))
    return out


def test_equals_grouping_everything(spark):
    rnd = random.Random(1)
    batches = [[(rnd.choice([None, *range(30)]), rnd.choice([None, "x", "y"]), i) for i in range(25)] for _ in range(5)] + [[]]
    for parts in (8, 2):
        _, _, _, out = run(spark, batches, max_parts=parts)
        assert [got for got, _ in out] == plain(batches)


def test_only_doubtful_batches_are_read(spark):
    batches = [[(k, "x", 0)] for k in range(4)] + [[(9, "x", 0), (2, "x", 1)], [(50, "x", 0), (50, "x", 0)]]
    check, dfs, older, out = run(spark, batches)
    assert [read for _, read in out] == [[], [], [], [], [["b2"]], []]
    assert out[4][0] == [(2, "x", 2)] and out[5][0] == [(50, "x", 2)]
    # a batch checked twice changes nothing
    parts = list(check.parts)
    assert [tuple(r) for r in check.check(dfs["b4"], "b4", older).collect()] == [(2, "x", 2)] and check.parts == parts


def test_fingerprints_that_meet_by_chance_are_no_violation(spark, monkeypatch):
    monkeypatch.setattr(U.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    batches = [[(1, "x", 0)], [(2, "x", 0)], [(1, "x", 0), (3, "z", 0)]]
    _, _, _, out = run(spark, batches)
    assert [got for got, _ in out] == [[], [], [(1, "x", 2)]]


def test_stored_prints_are_not_shuffled(spark):
    check, _, _, _ = run(spark, [[(k, "x", 0) for k in range(500)], [(k, "x", 0) for k in range(500, 900)]])
    prints = spark.createDataFrame([(1, "x")], "a long, b string").select(F.xxhash64("a", "b").alias(U.PRINT))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for p in check.parts:
            plan = check._part(p).join(prints, U.PRINT, "left_semi")._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
