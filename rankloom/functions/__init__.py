"""Column expressions and naming helpers."""

from .exprs import any_nonzero, null_double, ordinal, severity_absolute, severity_relative, sum0, truncate_long
from .fiscal import fiscal_range, fiscal_year, years_desc

__all__ = [
    "any_nonzero", "fiscal_range", "fiscal_year", "null_double", "ordinal",
    "severity_absolute", "severity_relative", "sum0", "truncate_long", "years_desc",
]
