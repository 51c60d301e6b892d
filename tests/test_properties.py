"""Property tests: the Spark operators against small pure-Python models of their semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loanmart.operators import scd2
from loanmart.operators import upsert as up
from loanmart.operators.keyed_store import KeyedStore
from loanmart.session import scratch_path

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 99)), max_size=8)


@SETTINGS
@given(target=rows, batches=st.lists(rows, min_size=1, max_size=3))
def test_upsert_matches_dict_merge(spark, target, batches):
    def dedup(rs):  # batches have unique keys
        return list({k: (k, v) for k, v in rs}.values())

    model = dict(dedup(target))
    t = spark.createDataFrame(dedup(target), "k int, v int")
    store = KeyedStore(spark, scratch_path(spark, "property-store"), ["k"], buckets=2, max_parts=2)
    store.merge(t)
    for b in batches:
        b = dedup(b)
        model.update(dict(b))
        t = up.upsert(t, spark.createDataFrame(b, "k int, v int"), ["k"])
        store.merge(spark.createDataFrame(b, "k int, v int"))
    assert sorted((r.k, r.v) for r in t.collect()) == sorted(model.items())
    assert sorted((r.k, r.v) for r in store.read().collect()) == sorted(model.items())


def python_scd2(batches, deletes=True):
    """Reference model of the timestamp strategy: list of (key, value, from, to).

    A returning key opens at its report time, or at the run if that is not past its delete.
    """
    versions = []  # [key, value, valid_from, valid_to, updated]
    for i, (batch, run_ts) in enumerate(batches):
        open_ = {v[0]: v for v in versions if v[3] is None}
        gone = {}
        for v in versions:
            if v[3] is not None:
                gone[v[0]] = max(v[3], gone.get(v[0], v[3]))
        for k, val, ts in batch:
            cur = open_.get(k)
            if cur is None:
                start = ts if k not in gone or ts >= gone[k] else run_ts
                versions.append([k, val, start, None, ts])
            elif ts > cur[4]:
                cur[3] = max(ts, cur[2])
                versions.append([k, val, cur[3], None, ts])
        if i > 0 and deletes:
            seen = {r[0] for r in batch}
            for k, cur in open_.items():
                if k not in seen:
                    cur[3] = run_ts
        versions = [v for v in versions if v[3] is None or v[3] > v[2]]
    return sorted((k, v, f, t or dt.datetime.max) for k, v, f, t, _ in versions)


day = st.integers(1, 9).map(lambda d: dt.datetime(2024, 1, d))
batch = st.lists(st.tuples(st.integers(0, 4), st.integers(300, 900), day), max_size=5)


@SETTINGS
@given(bs=st.lists(batch, min_size=1, max_size=4))
def test_scd2_matches_python_model(spark, bs):
    # one row per key per batch; report times never go backwards for a key
    last = {}
    clean = []
    for i, b in enumerate(bs):
        keyed = {}
        for k, val, ts in b:
            keyed[k] = (k, val, max(ts, last.get(k, ts)))
        for k, r in keyed.items():
            last[k] = r[2]
        clean.append((list(keyed.values()), dt.datetime(2024, 2, 1 + i)))
    dfs = [(spark.createDataFrame(b, "customer_id bigint, bureau_score bigint, report_date timestamp"), ts)
           for b, ts in clean]
    def versions(h):
        return sorted((r.customer_id, r.bureau_score, r.dbt_valid_from, r.dbt_valid_to or dt.datetime.max) for r in h.collect())

    assert versions(scd2.replay(dfs, "customer_id", "report_date")) == python_scd2(clean)
    # the stored form keeps changes only, compacted now and then
    root = scratch_path(spark, "property-history")
    schema = scd2.initial_history(dfs[0][0], "customer_id", "report_date").schema
    for k, (b, ts) in enumerate(dfs):
        scd2.run_snapshot(root, b, "customer_id", "report_date", ts)
        if k == 1:
            scd2.compact(spark, root, schema)
    assert versions(scd2.stored_history(spark, root, schema)) == python_scd2(clean)
