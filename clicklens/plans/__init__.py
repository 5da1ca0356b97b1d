"""End-to-end plans built from sources, operators and sinks."""

from clicklens.plans.job import JobResult, SearchKeywordJob, read_input, transform_hits

__all__ = ["JobResult", "SearchKeywordJob", "read_input", "transform_hits"]
