"""The report as one dated, tab-separated file.

Steps: format each row as one TSV line (revenue with two decimals, minimal
quoting), put the header line first, sort, write one part file (CRLF line
ends, as Python's csv writer) to a stage folder next to the target, copy it
over the dated name, and only then remove the stage.

Scale: the hits are aggregated before; the lines, one per domain and keyword,
go through the one sorted task that a single file needs (its sort spills).
Where that is too much, ``part_files=True`` writes a folder instead: sorted
part files, written by all tasks, and the header in a file of its own.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicklens.constants import REPORT_DOMAIN, REPORT_FILE_SUFFIX, REPORT_KEYWORD, REPORT_REVENUE
from clicklens.operators.aggregate import report_order
from clicklens.sinks.files import child, copy_over, listed, qualified, remove
from clicklens.sources.tsv import tsv_line


def dated_name(day: dt.date | None = None) -> str:
    """File name of a day's report; the driver's own day unless given."""
    return str(day or dt.date.today()) + REPORT_FILE_SUFFIX


def revenue_text(c: str = REPORT_REVENUE):
    """Two decimals, rounded half-even on the exact double, no grouping commas."""
    return F.regexp_replace(F.format_number(F.col(f"`{c}`"), 2), ",", "")


def report_as_text(report: DataFrame) -> DataFrame:
    """Labelled report with ``Revenue`` as two-decimal text, sorted."""
    return report.orderBy(*report_order()).select(
        F.col(f"`{REPORT_DOMAIN}`"),
        F.col(f"`{REPORT_KEYWORD}`"),
        revenue_text().alias(REPORT_REVENUE),
    )


HEADER_LINE = "\t".join((REPORT_DOMAIN, REPORT_KEYWORD, REPORT_REVENUE))


def _line_order() -> list[Column]:
    return [F.col("_part"), F.col("_rev").desc(), F.col("_dom"), F.col("_kw")]


def _keyed_lines(report: DataFrame) -> DataFrame:
    return report.select(
        F.lit(1).alias("_part"),
        F.col(f"`{REPORT_REVENUE}`").alias("_rev"),
        F.col(f"`{REPORT_DOMAIN}`").alias("_dom"),
        F.col(f"`{REPORT_KEYWORD}`").alias("_kw"),
        tsv_line(F.col(f"`{REPORT_DOMAIN}`"), F.col(f"`{REPORT_KEYWORD}`"), revenue_text()).alias("line"),
    )


def report_lines(report: DataFrame, observation: Observation | None = None) -> DataFrame:
    """The file's lines, in order, in one partition: the header, then one TSV line per report row.

    Fields holding a tab, quote or line break are quoted with inner quotes
    doubled (minimal quoting, as Python's csv writer does). An
    ``observation`` receives ``rows``.
    """
    rows = _keyed_lines(report)
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
    header = report.sparkSession.range(0, 1, 1, 1).select(
        F.lit(0).alias("_part"),
        F.lit(None).cast("double").alias("_rev"),
        F.lit(None).cast("string").alias("_dom"),
        F.lit(None).cast("string").alias("_kw"),
        F.lit(HEADER_LINE).alias("line"),
    )
    return header.unionByName(rows).repartition(1).sortWithinPartitions(*_line_order()).select("line")


def publish_single_file(spark: SparkSession, stage_dir: str, target: str) -> str:
    """Copy the one part file of ``stage_dir`` over ``target``, then drop the stage.

    Where this fails, the stage stays: it holds the whole report, whatever
    became of the target. (A rename onto an existing name is not one step on
    every file system, and object stores have none.)
    """
    parts = [p for p in listed(spark, stage_dir) if p.rpartition("/")[2].startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file under {stage_dir}, found {len(parts)}")
    copy_over(spark, parts[0], target)
    remove(spark, stage_dir)
    return qualified(spark, target)


def write_report_file(
    report: DataFrame,
    output_prefix: str,
    run_date: dt.date | None = None,
    observation: Observation | None = None,
    line_sep: str = "\r\n",
    part_files: bool = False,
) -> str:
    """Write the labelled report under its dated name in the folder ``output_prefix``; returns the path.

    Header line, then rows by revenue (descending), domain, keyword; lines end
    in CRLF by default. Zero rows give a header-only file. An ``observation``
    receives ``rows``, the number of report rows. With ``part_files`` the
    dated name is a folder: ``header.tab`` and sorted ``rows/part-*`` files.
    """
    spark = report.sparkSession
    target = child(output_prefix, dated_name(run_date))
    if part_files:
        rows = _keyed_lines(report).orderBy(*_line_order())
        if observation is not None:  # above the sort, whose sampling would count too
            rows = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
        write = {"lineSep": line_sep}
        rows.select("line").write.mode("overwrite").options(**write).text(child(target, "rows"))
        header = spark.range(0, 1, 1, 1).select(F.lit(HEADER_LINE).alias("line"))
        header.write.mode("overwrite").options(**write).text(child(target, "_header"))
        publish_single_file(spark, child(target, "_header"), child(target, "header.tab"))
        return qualified(spark, target)
    stage = f"{target}._stage-{uuid.uuid4().hex[:12]}"
    try:
        report_lines(report, observation).write.option("lineSep", line_sep).text(stage)
    except Exception:
        remove(spark, stage)  # nothing was published
        raise
    return publish_single_file(spark, stage, target)


def read_report_file(spark: SparkSession, path: str) -> DataFrame:
    """Read a published report back (all columns as text; quoted fields may hold line breaks)."""
    return spark.read.options(header="true", sep="\t", quote='"', escape='"', multiLine="true").csv(path)
