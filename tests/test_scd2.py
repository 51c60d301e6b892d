"""Type-2 history: one open version per key, no overlaps, replay is a no-op,
hard deletes close, returning keys reopen, equal timestamps change nothing."""

import datetime as dt
import os

from pyspark.sql import functions as F

from loanmart.operators import scd2

SCHEMA = "customer_id bigint, bureau_score bigint, report_date timestamp"


def T(d):
    return dt.datetime(2024, 1, d)


def run(spark, batches, deletes=True):
    dfs = [(spark.createDataFrame(rows, SCHEMA), T(i + 20)) for i, rows in enumerate(batches)]
    return scd2.replay(dfs, "customer_id", "report_date", invalidate_hard_deletes=deletes)


def versions(h):
    vs = [(r.customer_id, r.bureau_score, r.dbt_valid_from, r.dbt_valid_to) for r in h.collect()]
    return sorted(vs, key=lambda v: (v[0], v[2], v[3] or dt.datetime.max, v[1]))


def test_new_change_same_and_delete(spark):
    b1 = [(1, 500, T(1)), (2, 600, T(1)), (3, 700, T(1))]
    b2 = [(1, 510, T(2)),            # newer report -> new version
          (2, 999, T(1))]            # same timestamp, other score -> no change; 3 missing -> closed at run time
    h = run(spark, [b1, b2])
    assert versions(h) == [
        (1, 500, T(1), T(2)), (1, 510, T(2), None),
        (2, 600, T(1), None),
        (3, 700, T(1), T(21))]


def test_hard_deletes_off_keeps_version_open(spark):
    h = run(spark, [[(3, 700, T(1))], [(4, 1, T(2))]], deletes=False)
    assert versions(h) == [(3, 700, T(1), None), (4, 1, T(2), None)]


def test_returning_key_opens_at_the_run_or_at_its_newer_report(spark):
    # gone at the run of day 21; back with the old report at the run of day 22
    h = run(spark, [[(1, 500, T(1))], [], [(1, 500, T(1))]])
    assert versions(h) == [(1, 500, T(1), T(21)), (1, 500, T(22), None)]
    # back with a report past the delete
    h = run(spark, [[(1, 500, T(1))], [], [(1, 510, T(25))]])
    assert versions(h) == [(1, 500, T(1), T(21)), (1, 510, T(25), None)]
    # a newer report after the return; one that starts where the reopened version does replaces it
    h = run(spark, [[(1, 500, T(1))], [], [(1, 500, T(1))], [(1, 520, T(23))]])
    assert versions(h) == [(1, 500, T(1), T(21)), (1, 500, T(22), T(23)), (1, 520, T(23), None)]
    h = run(spark, [[(1, 500, T(1))], [], [(1, 500, T(1))], [(1, 520, T(22))]])
    assert versions(h) == [(1, 500, T(1), T(21)), (1, 520, T(22), None)]
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_stored_history_reads_like_the_replay(spark, tmp_path):
    root = str(tmp_path / "history")
    days = [[(1, 500, T(1)), (2, 600, T(1))], [(2, 600, T(1))], [(1, 500, T(1)), (2, 650, T(12))], [(1, 500, T(1)), (2, 650, T(12))]]
    for i, rows in enumerate(days):
        for _ in range(2 if i == 2 else 1):  # a run may be repeated
            scd2.run_snapshot(root, spark.createDataFrame(rows, SCHEMA), "customer_id", "report_date", T(i + 20))
    assert versions(scd2.stored_history(spark, root)) == versions(run(spark, days))
    current = scd2.stored_open(spark, root)
    assert sorted((r.customer_id, r.bureau_score) for r in current.collect()) == [(1, 500), (2, 650)]
    plan = current._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def stored_rows(root):
    """Rows in the files of each run's folder."""
    import pyarrow.parquet as pq
    out = {}
    for folder, _, files in os.walk(root):
        for f in files:
            if f.endswith(".parquet") and "/runs/" in folder:
                run = folder.split("snapshot_run=")[1].split("/")[0]
                out[run] = out.get(run, 0) + pq.read_metadata(os.path.join(folder, f)).num_rows
    return out


def test_a_run_writes_its_changes_only(spark, tmp_path):
    root = str(tmp_path / "changes")
    base = [(k, 500, T(1)) for k in range(200)]
    days = [base, base, [(k, 510, T(2)) if k < 3 else (k, 500, T(1)) for k in range(199)]]
    for i, rows in enumerate(days):
        scd2.run_snapshot(root, spark.createDataFrame(rows, SCHEMA), "customer_id", "report_date", T(i + 20))
    # a run without changes writes nothing; three changes and a delete are seven rows
    assert stored_rows(root) == {scd2.run_id(T(20)): 200, scd2.run_id(T(22)): 7}


def test_compaction_changes_no_reader(spark, tmp_path):
    root = str(tmp_path / "compacted")
    days = [[(1, 500, T(1)), (2, 600, T(1)), (3, 1, T(1))], [(2, 610, T(3)), (3, 1, T(1))], [(1, 500, T(1)), (2, 610, T(3)), (3, 2, T(4))],
            [(1, 505, T(22)), (3, 2, T(4))], [(1, 505, T(22)), (2, 700, T(24)), (3, 2, T(4))]]
    dfs = [spark.createDataFrame(rows, SCHEMA) for rows in days]
    schema = scd2.initial_history(dfs[0], "customer_id", "report_date").schema
    scd2.compact(spark, root, schema)  # nothing stored yet
    for i, batch in enumerate(dfs):
        scd2.run_snapshot(root, batch, "customer_id", "report_date", T(i + 20))
        want = versions(run(spark, days[:i + 1]))
        assert versions(scd2.stored_history(spark, root)) == want
        if i != 3:
            scd2.compact(spark, root)
            assert versions(scd2.stored_history(spark, root)) == want
            assert versions(scd2.stored_open(spark, root)) == [v for v in want if v[3] is None]
    # a folded run that is run again with other rows is folded no more
    scd2.run_snapshot(root, spark.createDataFrame([(1, 505, T(22))], SCHEMA), "customer_id", "report_date", T(24))
    assert versions(scd2.stored_history(spark, root)) == versions(run(spark, days[:4] + [[(1, 505, T(22))]]))


def test_a_version_that_starts_past_the_run_is_void_when_deleted(spark, tmp_path):
    root = str(tmp_path / "void")
    days = [[(1, 500, T(1)), (2, 600, T(28))], [(1, 500, T(1))], [(1, 500, T(1)), (2, 600, T(28))]]
    for i, rows in enumerate(days):
        scd2.run_snapshot(root, spark.createDataFrame(rows, SCHEMA), "customer_id", "report_date", T(i + 20))
        assert versions(scd2.stored_history(spark, root)) == versions(run(spark, days[:i + 1]))
    assert (2, 600, T(28), None) in versions(scd2.stored_history(spark, root))


def test_replay_is_noop_and_invariants(spark):
    import random
    rnd = random.Random(7)
    batches = []
    for b in range(6):
        rows = []
        for k in range(40):
            if rnd.random() < 0.85:
                rows.append((k, rnd.randint(300, 950), T(1 + b * 2 - rnd.randint(0, 1) * (b > 0))))
        batches.append(rows)
    h = run(spark, batches)
    again = run(spark, batches + [batches[-1]])
    # replaying the last batch changes nothing
    assert versions(h) == versions(again)
    # at most one open version per key
    assert h.where("dbt_valid_to is null").groupBy("customer_id").count().where("count > 1").count() == 0
    # validity intervals of a key are disjoint, only the last may be open; ids are unique
    vs = {}
    for r in h.collect():
        vs.setdefault(r.customer_id, []).append((r.dbt_valid_from, r.dbt_valid_to))
    for k, iv in vs.items():
        iv.sort(key=lambda v: (v[0], v[1] or dt.datetime.max))
        for (a0, a1), (b0, b1) in zip(iv, iv[1:]):
            assert a1 is not None and a0 < a1 <= b0, (k, iv)
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_scd_id_and_current(spark):
    h = run(spark, [[(1, 500, T(1))], [(1, 510, T(2))]])
    import hashlib
    ids = {r.dbt_scd_id for r in h.collect()}
    assert hashlib.md5(b"1|2024-01-01 00:00:00").hexdigest() in ids
    assert [r.bureau_score for r in scd2.current(h).collect()] == [510]
    assert [r.bureau_score for r in scd2.as_of(h, F.lit(T(1)).cast("timestamp")).collect()] == [500]


def test_deleted_keys(spark):
    h = run(spark, [[(1, 500, T(1)), (2, 1, T(1))], [(1, 510, T(2))]])
    got = [(r.customer_id, r.dbt_valid_to) for r in scd2.deleted_keys(h, "customer_id").collect()]
    assert got == [(2, T(21))]


def test_score_monthly_month_ends(spark):
    from loanmart.params import RunParams
    from loanmart.plans import metrics
    b1 = [(1, 700, dt.datetime(2024, 2, 29)), (2, 600, dt.datetime(2024, 2, 10))]
    b2 = [(1, 800, dt.datetime(2024, 4, 15))]
    h = scd2.replay([(spark.createDataFrame(b1, SCHEMA), dt.datetime(2024, 3, 1)),
                     (spark.createDataFrame(b2, SCHEMA), dt.datetime(2024, 4, 16))],
                    "customer_id", "report_date")
    got = sorted((r.month_end, r.bureau_risk_tier, r.customers, r.avg_bureau_score)
                 for r in metrics.score_monthly(h, RunParams(as_of=dt.date(2024, 4, 20))).collect())
    # key 2 deleted at the 2024-04-16 run: valid at the end of Feb and Mar only
    feb, mar, apr = dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 30)
    assert got == [(feb, "HIGH_RISK", 1, 600.0), (feb, "MEDIUM_RISK", 1, 700.0),
                   (mar, "HIGH_RISK", 1, 600.0), (mar, "MEDIUM_RISK", 1, 700.0),
                   (apr, "LOW_RISK", 1, 800.0)]
