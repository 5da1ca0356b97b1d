"""clicklens: revenue from external search, by engine and keyword, on Spark.

Typical use::

    from clicklens import SearchKeywordJob, keyword_report, read_hits
    SearchKeywordJob(input_path, output_prefix).run(spark)
    keyword_report(read_hits(spark, path)).show()
"""

from clicklens.operators import keyword_report, keyword_revenue, qualified_hits
from clicklens.plans import SearchKeywordJob, transform_hits
from clicklens.sinks import write_report_file, write_report_table
from clicklens.sources.tsv import hits_from_lines, read_hits, read_hits_stream

__all__ = [
    "SearchKeywordJob",
    "hits_from_lines",
    "keyword_report",
    "keyword_revenue",
    "qualified_hits",
    "read_hits",
    "read_hits_stream",
    "transform_hits",
    "write_report_file",
    "write_report_table",
]
