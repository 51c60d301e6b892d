"""Column -> Column helpers shared by the models.

All helpers build Catalyst expressions (no Python UDFs), so every model stays
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for equal results) -----------
# Masking patterns for non-production targets.
MASK_EMAIL_SUFFIX = "***@masked.com"
MASK_STARS = "****"
MASK_OTHER = "*** MASKED ***"
# Null placeholder and field separator of the pinned surrogate-key macro.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"
# ---------------------------------------------------------------------------

PII_KINDS = ("email", "phone", "name", "birth_date")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_pii(c: Column | str, kind: str, enabled: bool = True) -> Column:
    """Mask a PII value by kind; identity when masking is disabled (production).

    email      -> first 2 chars + fixed domain
    phone      -> first 4 chars + stars + last 2 chars
    name       -> first char + stars
    birth_date -> first day of the year
    other      -> constant marker
    """
    c = _col(c)
    if not enabled:
        return c
    if kind == "email":
        return F.concat(F.substring(c, 1, 2), F.lit(MASK_EMAIL_SUFFIX))
    if kind == "phone":
        return F.concat(F.substring(c, 1, 4), F.lit(MASK_STARS), F.substring(c, -2, 2147483647))
    if kind == "name":
        return F.concat(F.substring(c, 1, 1), F.lit(MASK_STARS))
    if kind == "birth_date":
        return F.trunc(c, "year")
    return F.lit(MASK_OTHER)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the key fields cast to string, nulls replaced by a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END (a NULL condition gives false)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def first_match(branches: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Ordered searched CASE: the first true condition wins."""
    out = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def ladder_at_least(c: Column | str, steps: Iterable[tuple[float, str]], otherwise: str | None) -> Column:
    """Threshold ladder `c >= t1 -> l1, c >= t2 -> l2, ...` (steps in descending order)."""
    c = _col(c)
    return first_match([(c >= t, label) for t, label in steps], otherwise)


def ladder_below(c: Column | str, steps: Iterable[tuple[float, str]], otherwise: str | None) -> Column:
    """Threshold ladder `c < t1 -> l1, c < t2 -> l2, ...` (steps in ascending order)."""
    c = _col(c)
    return first_match([(c < t, label) for t, label in steps], otherwise)


def ratio(num: Column, den: Column, scale: int = 4) -> Column:
    """round(num / den, scale) with a NULL result when den is NULL or 0 (NULLIF form)."""
    return F.round(num / F.nullif(den, F.lit(0)), scale)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Day difference end - start as a 64-bit integer (NULL if either is NULL)."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def money(c: Column | str) -> Column:
    """Money values are decimal(18,2): exact sums and half-up rounding."""
    return _col(c).cast("decimal(18,2)")


def rate(c: Column | str) -> Column:
    """Percentage rates are decimal(9,4)."""
    return _col(c).cast("decimal(9,4)")


def avg_exact(c: Column | str) -> Column:
    """Mean of a decimal column without the 6-digit cut of decimal avg: sum / count as double."""
    c = _col(c)
    return F.sum(c).cast("double") / F.count(c)


def count_if_true(c: Column | str) -> Column:
    """sum(case when c then 1 else 0 end): NULL counts as false."""
    return F.sum(F.when(_col(c), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
