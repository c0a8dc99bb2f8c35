"""Ranking order (O-1..O-6).  A rank is the row order of the written table;
every sort ends with all level keys so ties are broken deterministically."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ordinal
from ..plans.spec import FiscalSpec, LevelSpec, MergePolicy


def _tiebreak(level: LevelSpec, df: DataFrame) -> list[Column]:
    return [F.col(k).asc_nulls_first() for k in level.keys if k in df.columns]


def newest_sales_column(df: DataFrame, fiscal: FiscalSpec) -> str | None:
    for fy in fiscal.years_desc():
        c = fiscal.col("sales", fy)
        if c in df.columns:
            return c
    return None


def rank_order(df: DataFrame, level: LevelSpec, fiscal: FiscalSpec, policy: MergePolicy, sales_present: bool | None = None) -> list[Column]:
    """Sort columns of one level.

    corp/customer (O-1): current sales descending.  If the current sales
    column is absent (O-3) the newest existing year's sales, descending with
    nulls first.  Quarter (O-5): an empty list, so nothing is sorted, unless
    ``sales_present``.
    product: 'sales' (O-2) current sales desc then office; fallback office,
    customer name, category.  'office' (O-4): custom office order (unlisted
    after, null first), then customer name, category."""
    sales = fiscal.sales_col
    has_sales = sales in df.columns if sales_present is None else sales_present
    tie = _tiebreak(level, df)
    if level.name != "customer_product":
        if has_sales:
            return [F.col(sales).desc_nulls_first()] + tie
        if policy.product_order == "office":  # quarter: no order at all
            return []
        newest = newest_sales_column(df, fiscal)
        return ([F.col(newest).desc_nulls_first()] if newest else []) + tie
    if policy.product_order == "office":
        return [
            ordinal("office", policy.office_order).asc_nulls_first(),
            F.col("cust_name").asc_nulls_first(),
            F.col("category").asc_nulls_first(),
        ] + tie
    if has_sales:
        return [F.col(sales).desc_nulls_first(), F.col("office").asc_nulls_first()] + tie
    return [F.col(c).asc_nulls_first() for c in ("office", "cust_name", "category")] + tie


def rank(df: DataFrame, level: LevelSpec, fiscal: FiscalSpec, policy: MergePolicy) -> DataFrame:
    """Global order (range-partitioned sort: written part files are in rank
    order, no single-task bottleneck)."""
    return ordered(df, rank_order(df, level, fiscal, policy))


def ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    """The frame in that order; as it is (no shuffle) where there is none."""
    return df.orderBy(*order) if order else df


def keys_in_order(level: LevelSpec) -> bool:
    """Do equal sales of the product level leave its keys' own order (office first)?"""
    return level.keys[0] == "office"


def ordered_from_ranges(df: DataFrame, order: list[Column], first: str, below: bool = True) -> DataFrame:
    """:func:`ordered` for rows that lie in ranges of the later sort columns
    already, where ``order`` begins with ``first`` descending, nulls first.

    Rows with a zero there (a product level has one for every key without
    current sales) are in place and are sorted inside their partitions; only
    the others cross the network once more, to partitions before and after.
    ``below``: there may be values below zero (else one pass less over
    the rows)."""
    v = F.col(first)
    out = df.filter(v.isNull() | (v > 0)).orderBy(*order).union(df.filter(v == 0).sortWithinPartitions(*order))
    return out.union(df.filter(v < 0).orderBy(*order)) if below else out


def by_ranges(df: DataFrame, rank_col: str, rows: int, chunk: int) -> DataFrame:
    """Rows with a stored rank 1..``rows`` in its order: each partition takes
    a range of whole chunks.  A rank says by itself where its row goes, so
    nothing is sampled and no order is found again."""
    chunks = max(1, -(-rows // chunk))
    parts = min(chunks, max(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    per = chunk * -(-chunks // parts)
    place = F.floor((F.col(rank_col) - 1) / per).cast("int")
    return df.repartitionById(max(1, -(-rows // per)), place).sortWithinPartitions(rank_col)


def top_n(df: DataFrame, order: list[Column], n: int = 5, rank_col: str = "rank") -> DataFrame:
    """O-6 preview: the first ``n`` rows (TakeOrderedAndProject: each task
    keeps its own top n) numbered 1..n.  The window runs over the n limited
    rows only, never over the whole table."""
    limited = df.orderBy(*order).limit(n)
    return limited.select(F.row_number().over(Window.orderBy(*order)).alias(rank_col), *df.columns)
