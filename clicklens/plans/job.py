"""End-to-end batch job: hit TSV in, dated report file (and table) out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from clicklens.constants import (
    DOMAIN,
    KEYWORD,
    KEYWORD_PARAMS,
    PURCHASE_EVENT,
    REVENUE,
    SEARCH_ENGINE_HOSTS,
)
from clicklens.operators import exact_sum, keyword_report, keyword_revenue, labelled
from clicklens.sinks import read_report_table, write_report_file, write_report_table
from clicklens.sinks.report_table import write_report_parts
from clicklens.sources.tsv import data_files, read_hits


def transform_hits(hits: DataFrame) -> DataFrame:
    """Hits (contract columns) -> the labelled, sorted report."""
    return keyword_report(hits)


def read_input(
    spark: SparkSession, input_path: str, multi_line: bool = False, with_input_file: bool = False
) -> DataFrame:
    """The job's hit files in the contract columns."""
    return read_hits(spark, input_path, multi_line=multi_line, with_input_file=with_input_file)


@dataclass
class JobResult:
    output_file: str
    rows: int


@dataclass
class SearchKeywordJob:
    """Read hits from ``input_path``; write ``<output_prefix>/<date>_SearchKeywordPerformance.tab``.

    With ``table_path`` the aggregate is first written to the run-date table
    and the file is produced from that partition, so the hits are scanned once
    and the file stage starts from a written table rather than the lineage.
    """

    input_path: str
    output_prefix: str
    run_date: dt.date | None = None
    table_path: str | None = None
    multi_line: bool = False
    by_input: bool = False
    hosts: Sequence[str] = SEARCH_ENGINE_HOSTS
    params: Sequence[str] = KEYWORD_PARAMS
    purchase_event: str = PURCHASE_EVENT

    def run(self, spark: SparkSession) -> JobResult:
        """With ``by_input`` the table keeps one report per input file (column
        ``input_file``): a run replaces those of its own inputs and leaves the
        day's others; the dated file holds the report over this run's inputs."""
        run_date = self.run_date or dt.date.today()
        hits = read_input(spark, self.input_path, self.multi_line, with_input_file=self.by_input)
        keys = ("input_file",) if self.by_input else ()
        agg = keyword_revenue(hits, self.hosts, self.params, self.purchase_event, extra_keys=keys)
        if self.table_path:
            if self.by_input:
                inputs = data_files(spark, self.input_path)
                write_report_parts(agg, self.table_path, run_date, inputs)
                mine = spark.createDataFrame([(i,) for i in inputs], "input_file string")
                agg = read_report_table(spark, self.table_path, run_date, extra="input_file string").join(mine, "input_file", "left_semi")
            else:
                write_report_table(agg, self.table_path, run_date)
                agg = read_report_table(spark, self.table_path, run_date)
            agg = agg.drop("run_date")
        if self.by_input:
            agg = agg.groupBy(DOMAIN, KEYWORD).agg(exact_sum(REVENUE).alias(REVENUE))
        obs = Observation("report")
        out = write_report_file(labelled(agg), self.output_prefix, run_date, observation=obs)
        return JobResult(out, int(obs.get["rows"]))
