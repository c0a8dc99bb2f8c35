"""rankloom: multi-year sales rankings on Spark DataFrames.

Summarise the current fiscal year at three levels, merge with earlier
years' wide tables under explicit key and conflict policies, attach the
name master, shape and rank, reconcile totals, and write ordered tables.
"""

from .plans.spec import ANNUAL, CORP, CUSTOMER, CUSTOMER_PRODUCT, LEVELS, METRICS, QUARTER, FiscalSpec, LevelSpec, MergePolicy, MetricSpec

__all__ = [
    "ANNUAL", "CORP", "CUSTOMER", "CUSTOMER_PRODUCT", "LEVELS", "METRICS", "QUARTER",
    "FiscalSpec", "LevelSpec", "MergePolicy", "MetricSpec",
]
