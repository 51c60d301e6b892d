"""Each assertion kind with one planted violation, fused report == row-level forms."""

from pyspark.sql import functions as F

from loanmart.operators import assertions as A


def test_each_kind_counts_planted_violation(spark):
    child = spark.createDataFrame(
        [(1, "x", 10), (2, "y", 10), (2, "y", 20), (None, "bad", 30), (4, None, 99)],
        "id bigint, code string, parent bigint")
    parent = spark.createDataFrame([(10,), (20,)], "pid bigint")
    s = A.Suite()
    (s.table("child", child)
     .unique("id", "u").not_null("id", "nn").accepted_values("code", ["x", "y"], "av")
     .relationships("parent", parent, "pid", "parent", "rel")
     .unique_combination(["id", "code"], "uc")
     .rule("r", child.parent < 50))
    got = {r.assertion: r.failures for r in A.failure_report(s).collect()}
    assert got == {"u": 1, "nn": 1, "av": 1, "rel": 2, "uc": 1, "r": 1}
    # row-level forms agree
    assert A.unique_violations(child, "id").count() == 1
    assert A.not_null_violations(child, "id").count() == 1
    assert A.accepted_values_violations(child, "code", ["x", "y"]).count() == 1  # NULL passes
    assert A.relationship_violations(child, "parent", parent, "pid").count() == 2
    assert A.unique_combination_violations(child, ["id", "code"]).count() == 1


def test_clean_table_reports_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, code string")
    s = A.Suite()
    s.table("t", df).unique("id", "u").not_null("code", "n").accepted_values("code", ["a", "b"], "a")
    assert {r.failures for r in A.failure_report(s).collect()} == {0}


def test_relationships_grouped_by_parent(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "pid bigint, kind string")
    c1 = spark.createDataFrame([(1,), (4,), (4,), (None,)], "fk bigint")
    c2 = spark.createDataFrame([(2,), (5,)], "fk int")  # other key type: compared after a cast
    s = A.Suite()
    s.table("c1", c1).relationships("fk", parent, "pid", "p", "r1")
    s.table("c2", c2).relationships("fk", parent, "pid", "p", "r2")
    s.table("c2", c2).relationships("fk", parent.where("kind = 'a'"), "pid", "p_a", "r3")
    got = {r.assertion: r.failures for r in A.failure_report(s).collect()}
    assert got == {"r1": 2, "r2": 1, "r3": 2}


def test_malformed_keys_are_orphans(spark):
    from loanmart.operators import assertions as A

    child = spark.createDataFrame([("1",), ("7",), ("abc",), (None,), ("abc",)], "k string")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    suite = A.Suite()
    suite.table("child", child).relationships("k", parent, "id", "parent", "fk")
    assert [(r.assertion, r.failures) for r in A.failure_report(suite).collect()] == [("fk", 3)]
    assert sorted(r.k for r in A.relationship_violations(child, "k", parent, "id").collect()) == ["7", "abc", "abc"]


def test_checks_are_gathered_while_writing(spark):
    from loanmart.session import materialize
    df = spark.createDataFrame([(1, "a", 5.0), (None, "x", 1.0), (3, "x", None), (None, None, -1.0)], "id int, code string, v double")
    suite = A.Suite()
    (suite.table("t", df).not_null("id").not_null("v").accepted_values("code", ["a"], "one_bad").accepted_values("code", ["a", "x"], "none_bad")
     .accepted_values("code", ["z"], "two_bad").rule("positive", F.col("v") > 0))
    checks = suite.tables["t"].checks
    written, failures = A.observed_write(df, checks, lambda d: materialize(d, "observed"))
    assert written.count() == 4
    # several unaccepted values are left to the report
    assert failures == {"not_null_t_id": 2, "not_null_t_v": 1, "one_bad": 1, "none_bad": 0, "positive": 1}
    want = {r.assertion: r.failures for r in A.failure_report(suite).collect()}
    assert want == {**failures, "two_bad": 2}
    assert {r.assertion: r.failures for r in A.failure_report(suite, failures).collect()} == want
    empty, none = A.observed_write(df.limit(0), checks, lambda d: materialize(d, "observed"))
    assert empty.count() == 0 and set(none.values()) == {0}


def test_observed_checks_cost_no_scan(spark):
    from loanmart.session import materialize
    df = spark.range(5).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("code"))
    suite = A.Suite()
    suite.table("t", df).not_null("id").accepted_values("code", ["a"])
    written, failures = A.observed_write(df, suite.tables["t"].checks, lambda d: materialize(d, "observed"))
    suite.tables["t"].df = written
    plan = A.failure_report(suite, failures)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
