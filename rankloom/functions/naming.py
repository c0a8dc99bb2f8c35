"""Column names of reference-shaped files and their English counterparts.

The library works with English names (``corp_code``, ``sales_2025``).  Files
written by or for the original job use Japanese names and a year-prefixed
metric layout (``2025売上``); these helpers translate at the edges only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ..plans.spec import FiscalSpec

# Column names, metric labels, level labels and file-name
# parts that must equal the original job's files, in their natural order.
REFERENCE_KEY_NAMES = {
    "corp_code": "法人コード",
    "corp_name": "法人名",
    "cust_code": "得意先コード",
    "cust_name": "得意先名",
    "office": "営業所名",
    "rep_name": "担当者名",
    "category": "第1階層",
    "prod_code": "商品コード",
    "prod_name": "商品名",
}
# Detail (CSV) metric columns.
REFERENCE_DETAIL_METRICS = {
    "qty": "売上数",
    "area": "㎡",
    "sales": "売上金額",
    "profit": "粗利金額",
}
# Wide-table metric suffixes: "{year}{label}".
REFERENCE_WIDE_METRICS = {
    "qty": "売上数",
    "area": "㎡",
    "sales": "売上",
    "profit": "粗利",
}
REFERENCE_LEVEL_NAMES = {
    "corp": "法人",
    "customer": "得意先",
    "customer_product": "得意先（商品）",
}
# Legacy names found in older past tables.
LEGACY_CUSTOMER_RENAMES = {"取引先コード": "得意先コード", "取引先名": "得意先名"}
LEGACY_PRODUCT_RENAMES = {"得意先": "得意先名"}
# Labels in the names of the current summaries and of the past tables.
REFERENCE_TERMS = {"annual": "年度", "first_half": "上期", "quarter": "2Q"}
REFERENCE_PAST_TERMS = {"annual": "年度", "first_half": "上期", "quarter": "第２四半期"}
SUMMARY_FILE = "{term}_ランキング（得意先）_{level}.parquet"
RESULT_FILE = "{level}_転記用データ.parquet"

_WIDE_RE = re.compile(r"^(\d{4})(" + "|".join(sorted(REFERENCE_WIDE_METRICS.values(), key=len, reverse=True)) + r")$")
_WIDE_BACK = {v: k for k, v in REFERENCE_WIDE_METRICS.items()}
_KEY_BACK = {v: k for k, v in REFERENCE_KEY_NAMES.items()}


def to_reference(df: DataFrame, fiscal: FiscalSpec) -> DataFrame:
    """Rename English key and ``{metric}_{fy}`` columns to the reference names."""
    wide = {c: f"{fy}{REFERENCE_WIDE_METRICS[m.name]}" for c, (m, fy) in fiscal.metric_of().items()}
    mapping = {c: REFERENCE_KEY_NAMES.get(c, wide.get(c, c)) for c in df.columns}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def from_reference(df: DataFrame, fiscal: FiscalSpec) -> DataFrame:
    """Inverse of :func:`to_reference`; unknown columns keep their names."""
    mapping = {}
    for c in df.columns:
        if c in _KEY_BACK:
            mapping[c] = _KEY_BACK[c]
            continue
        m = _WIDE_RE.match(c)
        if m:
            mapping[c] = fiscal.col(_WIDE_BACK[m.group(2)], int(m.group(1)))
    return df.withColumnsRenamed(mapping)


def from_reference_detail(df: DataFrame) -> DataFrame:
    """Detail CSV columns -> English names (metrics unprefixed)."""
    back = {v: k for k, v in REFERENCE_DETAIL_METRICS.items()}
    back.update(_KEY_BACK)
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})


def summary_file(term: str, level: str) -> str:
    return SUMMARY_FILE.format(term=REFERENCE_TERMS.get(term, term), level=REFERENCE_LEVEL_NAMES.get(level, level))


def past_file(term: str, level: str) -> str:
    return SUMMARY_FILE.format(term=REFERENCE_PAST_TERMS.get(term, term), level=REFERENCE_LEVEL_NAMES.get(level, level))


def result_file(level: str) -> str:
    return RESULT_FILE.format(level=REFERENCE_LEVEL_NAMES.get(level, level))
