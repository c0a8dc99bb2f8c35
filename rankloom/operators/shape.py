"""Column order, types, null handling and the zero-row filter
(P-10..P-16, F-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_nonzero
from ..plans.spec import CODE_COLUMNS, REP_NAME, FiscalSpec, LevelSpec
from .merge import year_column_universe

PRODUCT_BASE = ("office", REP_NAME, "cust_code", "cust_name", "category", "prod_code", "prod_name")


def base_columns(level: LevelSpec, df: DataFrame) -> list[str]:
    if level.name == "customer_product":
        return [c for c in PRODUCT_BASE if c in df.columns]
    return [c for c in level.columns if c in df.columns]


def reorder_filter(df: DataFrame, level: LevelSpec, fiscal: FiscalSpec) -> DataFrame:
    """P-11 (annual): base columns and the current quantity, then every year
    column in its existing order except last year's quantity; all other
    columns are discarded."""
    base = base_columns(level, df) + [fiscal.col("qty", fiscal.current_fy)]
    universe = year_column_universe(fiscal)
    skip = {fiscal.col("qty", fiscal.current_fy - 1)} | set(base)
    years = [c for c in df.columns if c in universe and c not in skip]
    cols = [c for c in base if c in df.columns] + years
    return df.select(*cols) if cols else df


def reorder_generated(df: DataFrame, level: LevelSpec, fiscal: FiscalSpec) -> DataFrame:
    """P-12 (quarter): keys, then per year newest first [qty] area sales profit."""
    keys = [c for c in level.columns if c in df.columns]
    years = [c for c in fiscal.all_year_columns() if c in df.columns]
    return df.select(*keys, *years)


def codes_to_string(df: DataFrame) -> DataFrame:
    """P-13: code columns as strings wherever present."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in CODE_COLUMNS else F.col(c) for c in df.columns])


def finalise_metrics(df: DataFrame, fiscal: FiscalSpec, final_type: str | None = "double") -> DataFrame:
    """P-14: every year metric null -> 0, cast to ``final_type`` (quarter)."""
    wanted = set(fiscal.all_year_columns())
    out = []
    for c in df.columns:
        if c in wanted:
            v = F.coalesce(F.col(c), F.lit(0))
            out.append((v.cast(final_type) if final_type else v).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_column(df: DataFrame, col: str, value=0) -> DataFrame:
    """P-15: null -> ``value`` in one column only (type kept)."""
    if col not in df.columns:
        return df
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c == col else F.col(c) for c in df.columns])


def drop_zero_rows(df: DataFrame, fiscal: FiscalSpec) -> DataFrame:
    """F-1: keep a row if any existing year metric is non-zero.  Comparisons
    with null are unknown, so all-zero/null rows go; skipped when the frame
    has no year column.  The filter is pushed below a following sort."""
    cols = [c for c in fiscal.all_year_columns() if c in df.columns]
    return df.where(any_nonzero(cols)) if cols else df
