"""Report sinks: one dated TSV file, or a run-date partitioned table."""

from clicklens.sinks.report_file import (
    dated_name,
    publish_single_file,
    read_report_file,
    report_as_text,
    write_report_file,
)
from clicklens.sinks.report_table import read_report_table, write_report_table

__all__ = [
    "dated_name",
    "publish_single_file",
    "read_report_file",
    "read_report_table",
    "report_as_text",
    "write_report_file",
    "write_report_table",
]
