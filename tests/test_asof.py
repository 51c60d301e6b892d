"""The as-of join against a plain scan of each key's versions, with long keys and odd rows."""

import datetime as dt
import random

from loanmart.operators.asof import asof_join

EVENTS = "event_id int, customer_id long, at timestamp, v string"
VERSIONS = "customer_id long, score int, valid_from timestamp, valid_to timestamp"


def T(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def plain(events, versions):
    out = []
    for e, k, at, v in events:
        best = None
        for key, score, start, end in versions:
            if key is not None and key == k and start is not None and at is not None and start <= at:
                rank = (start, end is None, end or T(0), score is not None, score or 0)
                best = max(best or rank, rank)
        held = best and (best[1] or at < best[2])
        out.append((e, k, at, v, best[4] if held and best[3] else None, best[0] if held else None))
    return sorted(out, key=str)


def run(spark, events, versions, parts=4):
    e = spark.createDataFrame(events, EVENTS).repartition(parts)
    got = asof_join(e, spark.createDataFrame(versions, VERSIONS).repartition(parts), "customer_id", "at", "valid_from", "valid_to", ["score", "valid_from"])
    assert got.columns == ["event_id", "customer_id", "at", "v", "score", "valid_from"]
    return sorted((tuple(r) for r in got.collect()), key=str), got


def test_random_keys(spark):
    rnd = random.Random(3)
    versions, events = [], []
    for k in range(30):
        t = 0
        for i in range(rnd.randint(0, 8)):
            start, t = t, t + rnd.randint(1, 40)
            versions.append((k, 100 * k + i, T(start), None if rnd.random() < 0.2 else T(t - rnd.choice([0, 0, 1]) if t - 1 > start else t)))
        events += [(1000 * k + j, k, T(rnd.randint(-5, 200)), "e") for j in range(20)]
    assert run(spark, events, versions)[0] == plain(events, versions)


def test_a_key_with_most_rows(spark):
    rnd = random.Random(4)
    versions = [(7, i, T(10 * i), T(10 * i + 9)) for i in range(300)] + [(8, 1, T(0), None)]
    events = [(i, 7 if i % 20 else 8, T(rnd.randint(-20, 3100)), "e") for i in range(6000)]
    got, df = run(spark, events, versions)
    assert got == plain(events, versions)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # the swept rows of the long key lie in several ranges
    assert "_range" in plan and "windowspecdefinition(_key" in plan


def test_odd_rows(spark):
    versions = [(1, 5, T(10), None), (1, 6, T(10), T(20)), (1, None, T(30), None), (None, 9, T(0), None), (2, 4, None, None), (3, 3, T(5), T(5)), (4, 8, T(50), None), (4, 8, T(50), None)]
    events = [(1, 1, T(10), "x"), (2, 1, T(9), None), (3, 1, T(31), ""), (4, None, T(40), "x"), (5, 2, T(40), "x"), (6, 3, T(5), "x"), (7, 1, None, "x"), (8, 99, T(1), "x"), (9, 4, T(50), "x"), (9, 4, T(50), "x")]
    assert run(spark, events, versions)[0] == plain(events, versions)
    assert run(spark, [], versions)[0] == [] and run(spark, events, [])[0] == plain(events, [])
