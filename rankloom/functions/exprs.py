"""Column expressions shared by the operators (all built-in, codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from ..plans.spec import HIGH_REL_PCT, MEDIUM_REL_PCT, SEVERE_ABS_YEN, WARNING_ABS_YEN


def C(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c: str | Column) -> Column:
    """Sum that yields 0 for a group with no non-null value (as the original
    library does) instead of SQL's NULL."""
    return F.coalesce(F.sum(C(c)), F.lit(0))


def truncate_long(c: str | Column) -> Column:
    """Truncate toward zero and store as long (100.7 -> 100, -2.7 -> -2).
    The cast is checked: overflow raises under ANSI mode."""
    return C(c).cast("long")


def null_double() -> Column:
    return F.lit(None).cast("double")


def any_nonzero(cols: list[str]) -> Column:
    """True when any value is non-zero; false/null when every value is 0 or
    null, so a filter drops such rows (same outcome as the Kleene OR of
    ``c != 0``).  Written as ``greatest(abs(c)...) > 0`` -- greatest skips
    nulls -- so the optimizer sees one comparison instead of a wide OR tree,
    whose canonicalization blows up once pushed through large projections."""
    if len(cols) == 1:
        return F.abs(F.col(cols[0])) > 0
    return F.greatest(*[F.abs(F.col(c)) for c in cols]) > 0


def ordinal(c: str | Column, order: tuple[str, ...] | list[str]) -> Column:
    """Position of ``c`` in ``order``; unlisted values get ``len(order)``;
    null stays null (sorts first with ``asc_nulls_first``)."""
    col = C(c)
    expr = None
    for i, v in enumerate(order):
        expr = F.when(col == v, F.lit(i)) if expr is None else expr.when(col == v, F.lit(i))
    listed = F.lit(len(order)) if expr is None else expr.otherwise(F.lit(len(order)))
    return F.when(col.isNull(), F.lit(None).cast("int")).otherwise(listed)


def severity_absolute(abs_diff: Column, severe: float = SEVERE_ABS_YEN, warning: float = WARNING_ABS_YEN) -> Column:
    """Absolute ladder: > severe -> 'severe', > warning -> 'warning', else 'minor'."""
    return F.when(abs_diff > severe, "severe").when(abs_diff > warning, "warning").otherwise("minor")


def severity_relative(rel_pct: Column, high: float = HIGH_REL_PCT, medium: float = MEDIUM_REL_PCT) -> Column:
    """Relative ladder: > high % -> 'high', > medium % -> 'medium', else 'low'."""
    return F.when(rel_pct > high, "high").when(rel_pct > medium, "medium").otherwise("low")
