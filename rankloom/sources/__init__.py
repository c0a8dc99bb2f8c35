"""Sources and sinks."""

from .fixtures import DETAIL_SQL, corp_master, detail_view, table
from .readers import optional_parquet, read_detail_csv, read_levels, read_master_csv
from .writers import export_level, export_ready, write_levels, write_summary

__all__ = [
    "DETAIL_SQL", "corp_master", "detail_view", "export_level", "export_ready", "optional_parquet",
    "read_detail_csv", "read_levels", "read_master_csv", "table", "write_levels", "write_summary",
]
