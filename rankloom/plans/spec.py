"""Explicit specs for levels, metrics, fiscal years and merge policies.

The wide tables carry one column per (metric, fiscal year).  Instead of
discovering columns by sniffing their names, every step asks these specs
which columns exist, so the Spark plan is built from a known schema.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# Fixed values that must equal the original job's, stated together:
# the custom office order of the quarter ranking (Sapporo, Sendai, Tokyo,
# Osaka, Nagoya, Fukuoka); first year of the multi-year table; first month
# of the fiscal year; absolute severity thresholds in yen (severe above
# 1,000,000, warning above 100,000); relative severity thresholds in percent
# (high above 10, medium above 5); pre-merge conflict tolerance in yen;
# export size tiers (more than 50,000 rows -> 2000, more than 10,000 ->
# 1000, otherwise 500).
REFERENCE_OFFICE_ORDER = ("札幌", "仙台", "東京", "大阪", "名古屋", "福岡")
START_YEAR = 2015
FISCAL_START_MONTH = 4
SEVERE_ABS_YEN = 1_000_000
WARNING_ABS_YEN = 100_000
HIGH_REL_PCT = 10.0
MEDIUM_REL_PCT = 5.0
PREMERGE_TOLERANCE_YEN = 1000.0
EXPORT_TIERS = ((50_000, 2000), (10_000, 1000))
EXPORT_DEFAULT_CHUNK = 500


@dataclass(frozen=True)
class MetricSpec:
    """One summed measure.

    ``integral``: the sum is truncated toward zero and stored as ``long``
    (sales and profit).  ``past``: the measure is carried for earlier years
    (quantity is kept for the current year only).
    """

    name: str
    integral: bool = False
    past: bool = True


@dataclass(frozen=True)
class LevelSpec:
    """A ranking level: its grouping keys and optional descriptive attrs."""

    name: str
    keys: tuple[str, ...]
    attrs: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + self.attrs


QTY = MetricSpec("qty", integral=False, past=False)
AREA = MetricSpec("area", integral=False, past=True)
SALES = MetricSpec("sales", integral=True, past=True)
PROFIT = MetricSpec("profit", integral=True, past=True)
METRICS: tuple[MetricSpec, ...] = (QTY, AREA, SALES, PROFIT)

CORP = LevelSpec("corp", ("corp_code",), ("corp_name",))
CUSTOMER = LevelSpec("customer", ("cust_code", "cust_name"))
CUSTOMER_PRODUCT = LevelSpec(
    "customer_product",
    ("office", "cust_code", "cust_name", "category", "prod_code", "prod_name"),
)
LEVELS: tuple[LevelSpec, ...] = (CORP, CUSTOMER, CUSTOMER_PRODUCT)
LEVEL_BY_NAME = {lv.name: lv for lv in LEVELS}

# Retired key that older product tables may still carry.
REP_NAME = "rep_name"
# Code columns that must stay strings (leading zeros).
CODE_COLUMNS = ("corp_code", "cust_code", "prod_code")


def wide_name(metric: str, fy: int, template: str = "{metric}_{fy}") -> str:
    """Column name of ``metric`` for fiscal year ``fy`` in the wide layout."""
    return template.format(metric=metric, fy=fy)


@dataclass(frozen=True)
class FiscalSpec:
    """Fiscal calendar: the year starts in ``start_month``.

    ``current_fy`` is the year being summarised; earlier years run from
    ``start_year`` up to ``current_fy - 1``.
    """

    current_fy: int
    start_year: int = START_YEAR
    start_month: int = FISCAL_START_MONTH
    template: str = "{metric}_{fy}"
    metrics: tuple[MetricSpec, ...] = METRICS

    @staticmethod
    def as_of(day: _dt.date, start_year: int = START_YEAR, start_month: int = FISCAL_START_MONTH, **kw) -> "FiscalSpec":
        """Fiscal spec for the year containing ``day`` (explicit, never the clock)."""
        fy = day.year if day.month >= start_month else day.year - 1
        return FiscalSpec(fy, start_year, start_month, **kw)

    @property
    def last_fy(self) -> int:
        return self.current_fy - 1

    def years_desc(self) -> list[int]:
        """All years, newest first (inclusive range)."""
        return list(range(self.current_fy, self.start_year - 1, -1))

    def past_years_desc(self) -> list[int]:
        return list(range(self.current_fy - 1, self.start_year - 1, -1))

    def metrics_for(self, fy: int) -> list[MetricSpec]:
        """Current year keeps every metric, earlier years only the ``past`` ones."""
        return [m for m in self.metrics if fy == self.current_fy or m.past]

    def col(self, metric: str, fy: int) -> str:
        return wide_name(metric, fy, self.template)

    def year_columns(self, fy: int) -> list[str]:
        return [self.col(m.name, fy) for m in self.metrics_for(fy)]

    def all_year_columns(self) -> list[str]:
        """Generated column order: per year newest first, metrics in spec order."""
        return [c for fy in self.years_desc() for c in self.year_columns(fy)]

    def past_year_columns(self) -> list[str]:
        return [c for fy in self.past_years_desc() for c in self.year_columns(fy)]

    def current_columns(self) -> list[str]:
        return self.year_columns(self.current_fy)

    def metric_of(self) -> dict[str, tuple[MetricSpec, int]]:
        """Map every year column name to its (metric, year)."""
        return {self.col(m.name, fy): (m, fy) for fy in self.years_desc() for m in self.metrics_for(fy)}

    @property
    def sales_col(self) -> str:
        return self.col("sales", self.current_fy)


@dataclass(frozen=True)
class MergePolicy:
    """The switches that separate the annual and the quarter merge.

    missing_past:   'empty' (treat as no past) or 'error'
    missing_master: 'error' or 'skip'
    keys:           'coalesce' (USING-style keys) or 'left' (past-only rows
                    keep null keys, as a same-name full join without coalesce)
    conflict:       'fill_null' (past fills earlier years only where the
                    current table is null) or 'overwrite' (past wins)
    final_type:     None (keep types) or 'double'
    drop_zero_rows: remove rows whose every year metric is 0 or null
    product_order:  'sales' (current sales desc, office) or 'office'
                    (custom office order, customer name, category)
    severity:       'absolute' (yen thresholds) or 'relative' (percent)
    keep_rep_name:  keep the retired rep_name as a product key
                    if the past table still carries it (annual) or drop it
                    before re-aggregating (quarter)
    """

    name: str
    missing_past: str = "empty"
    missing_master: str = "error"
    keys: str = "coalesce"
    conflict: str = "fill_null"
    final_type: str | None = None
    drop_zero_rows: bool = False
    product_order: str = "sales"
    severity: str = "absolute"
    keep_rep_name: bool = True
    office_order: tuple[str, ...] = field(default_factory=tuple)

    def with_(self, **kw) -> "MergePolicy":
        return replace(self, **kw)



ANNUAL = MergePolicy(
    name="annual",
    missing_past="empty",
    missing_master="error",
    keys="coalesce",
    conflict="fill_null",
    final_type=None,
    drop_zero_rows=False,
    product_order="sales",
    severity="absolute",
    keep_rep_name=True,
)

QUARTER = MergePolicy(
    name="quarter",
    missing_past="error",
    missing_master="skip",
    keys="coalesce",
    conflict="overwrite",
    final_type="double",
    drop_zero_rows=True,
    product_order="office",
    severity="relative",
    keep_rep_name=False,
    office_order=REFERENCE_OFFICE_ORDER,
)
