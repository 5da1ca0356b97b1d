"""The report as a Parquet table partitioned by ``run_date``.

A run replaces its whole day (with ``part``, one part of the day): the rows
are written beside the table and moved into place, so rows of an earlier run
cannot survive, also where the new report is empty. Other days stay. Readers
that filter on ``run_date`` read only that partition.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.constants import DOMAIN, KEYWORD, REVENUE
from clicklens.sinks.files import child, exists, listed, move, remove

SCHEMA = f"{DOMAIN} string, {KEYWORD} string, {REVENUE} double"


def replace_folder(rows: DataFrame, table: str, folder: str) -> None:
    """``folder`` of ``table`` holds exactly ``rows`` afterwards.

    Written to a hidden folder first; the old content is moved aside before
    the new is moved in, and removed last, so a failure leaves one of them.
    """
    spark = rows.sparkSession
    mark = uuid.uuid4().hex[:12]
    stage, old, target = child(table, f"_stage-{mark}"), child(table, f"_old-{mark}"), child(table, folder)
    rows.write.parquet(stage)
    if exists(spark, target):
        move(spark, target, old)
    move(spark, stage, target)
    remove(spark, old)


def write_report_table(agg: DataFrame, path: str, run_date: dt.date, part: str | None = None) -> None:
    """Replace ``run_date`` (of it, the ``part``) with these (domain, keyword, revenue [, more columns]) rows."""
    day = f"run_date={run_date.isoformat()}"
    replace_folder(agg, path, f"{day}/part={part}" if part else day)


def plain_path(c: Column) -> Column:
    """A file path as the file source's metadata and a listing both spell it."""
    decoded = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([a-z0-9]+):/+", "$1:/")


def part_name(path: str) -> str:
    """Folder name of one input file's rows within a day."""
    return hashlib.sha256(path.encode()).hexdigest()[:16]


def write_report_parts(agg: DataFrame, path: str, run_date: dt.date, inputs: Sequence[str]) -> None:
    """Replace the rows of these ``inputs`` in the day, those without rows included; other inputs' rows stay.

    ``agg`` has a column ``input_file``. The rows are written beside the table
    once, then each input's folder is exchanged. Rows that a run without parts
    left in the day go.
    """
    spark = agg.sparkSession
    mark, day = uuid.uuid4().hex[:12], child(path, f"run_date={run_date.isoformat()}")
    stage, old = child(path, f"_stage-{mark}"), child(path, f"_old-{mark}")
    rows = agg.withColumn("input_file", plain_path(F.col("input_file")))
    rows.withColumn("part", F.substring(F.sha2("input_file", 256), 1, 16)).write.partitionBy("part").parquet(stage)
    if exists(spark, day):
        for left in listed(spark, day):
            if "=" not in left.rpartition("/")[2]:
                remove(spark, left)
    for one in sorted({f"part={part_name(i)}" for i in inputs}):
        if exists(spark, child(day, one)):
            move(spark, child(day, one), child(old, one))
        if exists(spark, child(stage, one)):
            move(spark, child(stage, one), child(day, one))
    remove(spark, old)
    remove(spark, stage)


def read_report_table(
    spark: SparkSession, path: str, run_date: dt.date | None = None, extra: str = ""
) -> DataFrame:
    """The table's rows, of one day where given; ``extra`` declares further columns (DDL).

    The schema is declared, so a table that only has empty reports reads as no rows.
    """
    schema = f"{SCHEMA}, {extra + ', ' if extra else ''}run_date date"
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    df = df.select(*(c.split()[0] for c in schema.split(", ")))
    return df.where(F.col("run_date").isNotNull() if run_date is None else F.col("run_date") == F.lit(run_date))
