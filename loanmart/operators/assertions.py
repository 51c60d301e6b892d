"""Table assertions: each returns the violating rows; zero rows means pass.

Failure counts follow the usual generic-test definitions:

* ``unique``            number of distinct non-NULL values occurring more than once
* ``unique_combination`` number of distinct column combinations occurring more than once
* ``not_null``          number of NULL rows
* ``accepted_values``   number of distinct non-NULL values outside the list
* ``relationships``     number of child rows (non-NULL key) without a parent row
* ``rule``              number of rows violating a row predicate

:func:`failure_report` evaluates a whole suite with few passes. Not-null, accepted-values
and rule checks need one look at each row: for a table that is written anyway they are
gathered while it is written (:func:`observed_write`) and cost no scan; for others, per
table, one aggregation. The rest is stacked over all tables: one shuffle of (check,
64-bit fingerprint of the key) for uniqueness, dealt to as many tasks as the keys need, and
one of the keys themselves whose fingerprint occurs twice; one for the few rows with an
unaccepted value; and one anti-join of pre-aggregated distinct child keys (skew-free) for
all foreign keys.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanmart.session import dealt, materialize

# --- row-level forms (what a failing test shows) ---------------------------

def unique_violations(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_combination_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values_violations(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .where(~F.col("value_field").isin(list(values))))


def relationship_violations(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows with a key that no parent row has (or that is none of its type).

    Orphan keys are found among the distinct ones, so a hot key is one row in
    the join with the parents; their rows then come from a join on those keys.
    """
    ptype = parent.schema[field_].dataType
    key = F.col(col) if child.schema[col].dataType == ptype else F.col(col).try_cast(ptype)
    keys = parent.select(F.col(field_).alias("__to")).distinct()
    orphans = (child.where(F.col(col).isNotNull()).select(F.col(col).alias("__orphan"), key.alias("__key")).distinct()
               .join(keys, F.col("__key") == F.col("__to"), "left_anti").select("__orphan"))
    return child.join(orphans, F.col(col) == F.col("__orphan"), "left_semi")


def rule_violations(df: DataFrame, ok: Column) -> DataFrame:
    """Rows where ``ok`` is false (a NULL outcome is not a violation)."""
    return df.where(~ok)


# --- suite ------------------------------------------------------------------

@dataclass
class Check:
    name: str
    kind: str
    columns: tuple
    values: tuple = ()
    parent: DataFrame | None = None
    parent_field: str | None = None
    predicate: Column | None = None


@dataclass
class TableChecks:
    table: str
    df: DataFrame
    checks: list = field(default_factory=list)


class Suite:
    """Declared assertions grouped by the table they read."""

    def __init__(self):
        self.tables: OrderedDict[str, TableChecks] = OrderedDict()

    def table(self, name: str, df: DataFrame) -> _TableBuilder:
        if name not in self.tables:
            self.tables[name] = TableChecks(name, df)
        return _TableBuilder(self.tables[name])

    def checks(self):
        for t in self.tables.values():
            for c in t.checks:
                yield t, c


class _TableBuilder:
    def __init__(self, t: TableChecks):
        self.t = t

    def _add(self, c: Check) -> _TableBuilder:
        self.t.checks.append(c)
        return self

    def unique(self, col: str, name: str | None = None):
        return self._add(Check(name or f"unique_{self.t.table}_{col}", "unique", (col,)))

    def unique_combination(self, cols: Sequence[str], name: str | None = None):
        return self._add(Check(name or f"unique_combination_{self.t.table}_{'_'.join(cols)}",
                               "unique_combination", tuple(cols)))

    def not_null(self, col: str, name: str | None = None):
        return self._add(Check(name or f"not_null_{self.t.table}_{col}", "not_null", (col,)))

    def accepted_values(self, col: str, values: Sequence, name: str | None = None):
        return self._add(Check(name or f"accepted_values_{self.t.table}_{col}", "accepted_values",
                               (col,), tuple(values)))

    def relationships(self, col: str, parent: DataFrame, parent_field: str, parent_name: str,
                      name: str | None = None):
        return self._add(Check(name or f"relationships_{self.t.table}_{col}__{parent_field}__{parent_name}",
                               "relationships", (col,), parent=parent, parent_field=parent_field))

    def rule(self, name: str, ok: Column):
        return self._add(Check(name, "rule", (), predicate=ok))


def _row_checks(checks: Sequence[Check]) -> list[Check]:
    return [c for c in checks if c.kind in ("not_null", "rule")]


def _row_count(c: Check) -> Column:
    bad = F.col(c.columns[0]).isNull() if c.kind == "not_null" else ~c.predicate
    return F.count(F.when(bad, F.lit(1))).cast("bigint")


def _unaccepted(c: Check) -> Column:
    return F.when(~F.col(c.columns[0]).isin(list(c.values)), F.col(c.columns[0]).cast("string"))


# --- checks gathered while a table is written ------------------------------------

def observed_write(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """``write(df)`` and the failures of the checks that one look at each row decides.

    The metrics ride along with the write. Of unaccepted values only the least and the
    greatest are kept: none or one distinct value is a count, with more of them the check
    is left to :func:`failure_report`, which counts them exactly.
    """
    rows, listed = _row_checks(checks), [c for c in checks if c.kind == "accepted_values"]
    metrics = [_row_count(c).alias(f"r{k}") for k, c in enumerate(rows)]
    for k, c in enumerate(listed):
        metrics += [F.min(_unaccepted(c)).alias(f"lo{k}"), F.max(_unaccepted(c)).alias(f"hi{k}")]
    if not metrics:
        return write(df), {}
    seen = Observation()
    out = write(df.observe(seen, *metrics))
    got = seen.get
    failures = {c.name: int(got[f"r{k}"] or 0) for k, c in enumerate(rows)}
    for k, c in enumerate(listed):
        lo, hi = got[f"lo{k}"], got[f"hi{k}"]
        if lo == hi:
            failures[c.name] = 0 if lo is None else 1
    return out, failures


# --- the report --------------------------------------------------------------------

def _scan_counts(t: TableChecks, checks: list[Check]) -> DataFrame:
    """not_null and rule checks of one table in one aggregation (no shuffle of rows)."""
    row = t.df.agg(*[_row_count(c).alias(f"r{k}") for k, c in enumerate(checks)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("assertion"), F.col(f"r{k}").alias("failures")) for k, c in enumerate(checks)])))


def _stacked(t: TableChecks, items: list[Column]) -> DataFrame:
    """The non-NULL ones among some structs of each row, one under the other."""
    return t.df.select(F.inline(F.array_compact(F.array(*items))))


def _accepted_values(t: TableChecks, checks: list[Check]) -> DataFrame:
    """(assertion, v) of the rows that hold an unaccepted value."""
    return _stacked(t, [F.when(_unaccepted(c).isNotNull(), F.struct(F.lit(c.name).alias("assertion"), _unaccepted(c).alias("v"))) for c in checks])


def _unique_keys(t: TableChecks, checks: list[Check]) -> DataFrame:
    """(assertion, k) of the keys that have to be unique."""
    stacked = []
    for c in checks:
        # keys as array<string>: one type for single and composite keys, and a
        # NULL element stays distinct from any value
        k = F.array(*[F.col(x).cast("string") for x in c.columns])
        # combination: NULLs take part in the grouping
        keep = F.col(c.columns[0]).isNotNull() if c.kind == "unique" else F.lit(True)
        stacked.append(F.when(keep, F.struct(F.lit(c.name).alias("assertion"), k.alias("k"))))
    return _stacked(t, stacked)


PRINT = "key_print"


def _repeated_keys(tables: Sequence[tuple[TableChecks, list[Check]]]) -> DataFrame | None:
    """(assertion, failures) of the uniqueness checks that fail; None if none does.

    What is grouped is a number for each key, not the key: a task holds little, and a bounded
    number of them. Only the keys behind repeated fingerprints are grouped themselves, and
    only checks that have some are read again; the counts are exact.
    """
    names = [c.name for _, checks in tables for c in checks]
    number = F.element_at(F.create_map(*[F.lit(x) for k, n in enumerate(names) for x in (n, k)]), F.col("assertion"))
    keys = _union([_unique_keys(t, checks) for t, checks in tables])
    prints = materialize(keys.select(number.cast("int").alias("check"), F.xxhash64("assertion", "k").alias(PRINT)), "key_prints")
    count = F.count(F.lit(1)).alias("n")
    rows = prints.count()
    suspects = materialize(dealt(prints, rows, "check", PRINT).groupBy("check", PRINT).agg(count).where("n > 1"), "repeated_prints")
    doubtful = {names[r["check"]]: r["n"] for r in suspects.groupBy("check").agg(F.sum("n").alias("n")).collect()}  # at most one for each check
    if not doubtful:
        return None
    again = _union([_unique_keys(t, own) for t, checks in tables if (own := [c for c in checks if c.name in doubtful])])
    again, total = again.withColumn(PRINT, F.xxhash64("assertion", "k")), sum(doubtful.values())
    met = again.join(suspects.select(PRINT), PRINT, "left_semi") if total <= rows // 2 else again
    twice = dealt(met, min(rows, total) if total <= rows // 2 else rows, PRINT).groupBy(PRINT, "assertion", "k").agg(count).where("n > 1")
    return twice.groupBy("assertion").agg(F.count(F.lit(1)).alias("failures"))


def _child_keys(t: TableChecks, c: Check, parent: str) -> DataFrame:
    """(assertion, parent, k, n): distinct keys of a child with their rows, as text of the parent's type."""
    k, ptype = F.col(c.columns[0]), c.parent.schema[c.parent_field].dataType
    if t.df.schema[c.columns[0]].dataType != ptype:
        k = k.try_cast(ptype)  # a key that does not cast has no parent: NULL matches none
    counted = t.df.where(F.col(c.columns[0]).isNotNull()).groupBy(k.cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(c.name).alias("assertion"), F.lit(parent).alias("parent"), "k", "n")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def failure_report(suite: Suite, observed: dict[str, int] | None = None) -> DataFrame:
    """One row per assertion: (assertion, failures). ``observed``: failures known already."""
    known = observed or {}
    names = [c.name for _, c in suite.checks()]
    if not names:
        raise ValueError("empty suite")
    spark = next(iter(suite.tables.values())).df.sparkSession
    # every assertion has a row, whether or not anything fails
    rows = F.array(*[F.struct(F.lit(n).alias("assertion"), F.lit(known.get(n, 0)).cast("bigint").alias("failures")) for n in names])
    parts = [spark.range(1).select(F.inline(rows))]
    accepted, unique, children, parents = [], [], [], OrderedDict()
    for t in suite.tables.values():
        open_ = [c for c in t.checks if c.name not in known]
        if scan := _row_checks(open_):
            parts.append(_scan_counts(t, scan))
        if listed := [c for c in open_ if c.kind == "accepted_values"]:
            accepted.append(_accepted_values(t, listed))
        if keys := [c for c in open_ if c.kind in ("unique", "unique_combination")]:
            unique.append((t, keys))
        for c in open_:
            if c.kind == "relationships":
                tag, _ = parents.setdefault((id(c.parent), c.parent_field), (f"p{len(parents)}", c))
                children.append(_child_keys(t, c, tag))
    count = F.count(F.lit(1))
    if accepted:
        values = _union(accepted).groupBy("assertion", "v").agg(count.alias("n"))
        parts.append(values.groupBy("assertion").agg(count.alias("failures")))
    if unique and (repeated := _repeated_keys(unique)) is not None:
        parts.append(repeated)
    if children:
        keys = _union([c.parent.where(F.col(c.parent_field).isNotNull()).select(F.lit(tag).alias("parent"), F.col(c.parent_field).cast("string").alias("k"))
                       for tag, c in parents.values()]).distinct()
        orphans = _union(children).join(keys, ["parent", "k"], "left_anti")
        parts.append(orphans.groupBy("assertion").agg(F.sum("n").alias("failures")))
    return _union(parts).groupBy("assertion").agg(F.sum("failures").cast("bigint").alias("failures"))
