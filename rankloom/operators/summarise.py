"""Level summaries of the current fiscal year (A-1, A-2, P-1..P-3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import sum0, truncate_long
from ..plans.spec import FiscalSpec, LevelSpec, MetricSpec


def metric_sum(m: MetricSpec, value: str | Column | None = None) -> Column:
    """Sum of one metric with the original job's rules: an all-null group
    sums to 0; integral metrics are truncated to long *after* summing."""
    s = sum0(m.name if value is None else value)
    return truncate_long(s) if m.integral else s


def safe_select(df: DataFrame, wanted: list[str]) -> DataFrame:
    """P-1: keep the wanted columns that exist, in wish-list order; an empty
    intersection returns the frame unchanged."""
    cols = [c for c in wanted if c in df.columns]
    return df.select(*cols) if cols else df


def summarise_level(detail: DataFrame, level: LevelSpec, fiscal: FiscalSpec, fy: int | None = None) -> DataFrame:
    """A-1: one row per level key (null keys form their own group) with the
    four year-prefixed metric sums.  Partial aggregation runs map-side, so
    a hot key costs one row per task in the shuffle."""
    fy = fiscal.current_fy if fy is None else fy
    return detail.groupBy(*level.keys).agg(
        *[metric_sum(m).alias(fiscal.col(m.name, fy)) for m in fiscal.metrics if m.name in detail.columns]
    )


def summarise(detail: DataFrame, levels: tuple[LevelSpec, ...], fiscal: FiscalSpec) -> dict[str, DataFrame]:
    """Three independent group-bys over one detail (A-2 as separate plans)."""
    return {lv.name: summarise_level(detail, lv, fiscal) for lv in levels}


def level_id_expr(levels: tuple[LevelSpec, ...], all_keys: list[str]) -> Column:
    """Level name from ``grouping_id``: bit i (from the left) is set when key i
    is rolled up.  The raw id is engine-specific, the name is not."""
    gid = F.grouping_id(*all_keys)
    n = len(all_keys)
    expr = None
    for lv in levels:
        code = sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in lv.keys)
        expr = F.when(gid == code, lv.name) if expr is None else expr.when(gid == code, lv.name)
    return expr


def summarise_grouping_sets(detail: DataFrame, levels: tuple[LevelSpec, ...], fiscal: FiscalSpec) -> DataFrame:
    """A-2 in one pass: ``GROUPING SETS`` over the detail scanned once.

    Output: a ``level`` column, the union of all level keys (keys of other
    levels are null), and the metric sums.  One Expand + partial aggregate
    per task and a single shuffle, instead of three scans of the detail."""
    all_keys: list[str] = []
    for lv in levels:
        all_keys += [k for k in lv.keys if k not in all_keys]
    sets = [[F.col(k) for k in lv.keys] for lv in levels]
    aggs = [metric_sum(m).alias(fiscal.col(m.name, fiscal.current_fy)) for m in fiscal.metrics if m.name in detail.columns]
    return detail.groupingSets(sets, *all_keys).agg(level_id_expr(levels, all_keys).alias("level"), *aggs)


def split_levels(combined: DataFrame, levels: tuple[LevelSpec, ...]) -> dict[str, DataFrame]:
    """Per-level frames of a grouping-sets result (read back from a table
    partitioned by ``level``, the filter prunes partitions)."""
    out = {}
    for lv in levels:
        metric_cols = [c for c in combined.columns if c not in ("level",) and c not in sum((l.keys for l in levels), ())]
        out[lv.name] = combined.where(F.col("level") == lv.name).select(*lv.keys, *metric_cols)
    return out


def _wide_select(df: DataFrame, keys: list[str], fiscal: FiscalSpec, years: list[int], name) -> list[Column]:
    out = [F.col(k) for k in keys]
    for fy in years:
        for m in fiscal.metrics_for(fy):
            c = F.col(name(fy, m.name))
            out.append((truncate_long(c) if m.integral else c).alias(fiscal.col(m.name, fy)))
    return out


#: The level with about as many groups as the detail has rows.
FINE_LEVEL = "customer_product"


def summarise_wide(
    detail: DataFrame, level: LevelSpec, fiscal: FiscalSpec, years: list[int] | None = None, fy_col: str = "fy", dealt: bool = False
) -> DataFrame:
    """Wide multi-year table (past layout): one row per key, per year the
    ``past`` metrics (all four for the current year).  A year without rows
    for a key is null (the key did not exist that year).

    Either way there is one exchange on the keys.  A level with few groups
    takes one conditional sum per year and metric, combined before the
    exchange; the product level goes by :func:`_wide_fine` (``dealt``: the
    detail's rows lie by a key of it, so that it needs none)."""
    years = fiscal.past_years_desc() if years is None else years
    if level.name == FINE_LEVEL:
        wide = _wide_fine(detail, level.keys, fiscal, years, fy_col, dealt)
    else:
        wide = detail.groupBy(*level.keys).agg(*_year_sums(fiscal, years, fy_col))
    return wide.select(*_wide_select(wide, list(level.keys), fiscal, years, lambda fy, m: f"{fy}_{m}"))


def _wide_fine(detail: DataFrame, keys: tuple[str, ...], fiscal: FiscalSpec, years: list[int], fy_col: str, dealt: bool) -> DataFrame:
    """``_year_sums`` per key where a group has hardly more than a row.

    Combining before the exchange saves no rows there, and a buffer for every
    year and metric makes each many times as wide as the detail.  So the
    detail itself is dealt by its keys, summed by key and year (one buffer
    per metric), and the years of a key are put side by side last, without
    another exchange: no sort or hash table holds a wide row.  Where the rows
    lie by one of the keys already (``dealt``) nothing is exchanged at all."""
    metrics = list(dict.fromkeys(m.name for fy in years for m in fiscal.metrics_for(fy)))
    rows = detail.select(*keys, fy_col, *metrics)
    rows = rows if dealt else rows.repartition(*[F.col(k) for k in keys])
    by_year = rows.groupBy(*keys, fy_col).agg(*[F.sum(m).alias(m) for m in metrics])
    by_hash = by_year.withColumn("_hash", F.xxhash64(*keys))  # a list per group is made by sorting: by a number first
    found = by_hash.groupBy("_hash", *keys).agg(
        F.collect_list(F.when(F.col(fy_col).isin(years), F.struct(fy_col, *metrics))).alias("_years"))
    of = lambda fy: F.get(F.filter("_years", lambda y: y[fy_col] == fy), F.lit(0))
    found = found.select(*keys, *[of(fy).alias(f"_{fy}") for fy in years])
    return found.select(*keys, *[F.col(f"_{fy}.{m.name}").alias(f"{fy}_{m.name}") for fy in years for m in fiscal.metrics_for(fy)])


def _year_sums(fiscal: FiscalSpec, years: list[int], fy_col: str) -> list[Column]:
    return [F.sum(F.when(F.col(fy_col) == fy, F.col(m.name))).alias(f"{fy}_{m.name}")
            for fy in years for m in fiscal.metrics_for(fy)]


def summarise_wide_levels(
    detail: DataFrame,
    levels: tuple[LevelSpec, ...],
    fiscal: FiscalSpec,
    years: list[int] | None = None,
    fy_col: str = "fy",
    combined_hook=None,
    dealt: bool = False,
) -> dict[str, DataFrame]:
    """Wide tables of several levels, as one table until the split.

    ``GROUPING SETS`` over the level keys with one conditional sum per year
    and metric: one Expand + partial aggregate per task and one shuffle.  The
    product level, whose groups are about as many as the detail's rows, is
    kept out of it (:func:`_wide_fine`): expanded, each of its rows would
    carry a buffer for every year and metric through the shuffle."""
    years = fiscal.past_years_desc() if years is None else years
    all_keys: list[str] = []
    for lv in levels:
        all_keys += [k for k in lv.keys if k not in all_keys]
    detail = detail.where(F.col(fy_col).isin(years))
    fine = [lv for lv in levels if lv.name == FINE_LEVEL]
    coarse = tuple(lv for lv in levels if lv.name != FINE_LEVEL)
    parts = []
    if coarse:
        keys = [k for k in all_keys if any(k in lv.keys for lv in coarse)]
        sets = [[F.col(k) for k in lv.keys] for lv in coarse]
        parts.append(detail.groupingSets(sets, *keys).agg(level_id_expr(coarse, keys).alias("level"), *_year_sums(fiscal, years, fy_col)))
    for lv in fine:
        parts.append(_wide_fine(detail, lv.keys, fiscal, years, fy_col, dealt).withColumn("level", F.lit(lv.name)))
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if combined_hook is not None:  # e.g. write once before the split
        wide = combined_hook(wide)
    out = {}
    for lv in levels:
        part = wide.where(F.col("level") == lv.name)
        out[lv.name] = part.select(*_wide_select(part, list(lv.keys), fiscal, years, lambda fy, m: f"{fy}_{m}"))
    return out
