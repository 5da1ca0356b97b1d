"""Structured Streaming jobs over arriving hit files."""

from clicklens.streaming.incremental import incremental_report, read_ledger, read_running_revenue, running_revenue

__all__ = ["incremental_report", "read_ledger", "read_running_revenue", "running_revenue"]
