"""Sources (table discovery and reading) and sinks (result tables, reports)."""

from assay.sources.results import nested_report, read_metrics, write_report, write_result
from assay.sources.tables import list_tables, read_table, table_name_of

__all__ = [
    "list_tables",
    "nested_report",
    "read_metrics",
    "read_table",
    "table_name_of",
    "write_report",
    "write_result",
]
