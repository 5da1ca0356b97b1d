"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame``.

Every query reads the test tables (``events``, ``pages``) or data Spark
derives from them, over whole tables. Queries that exercise files (sources,
sinks, streams) write under the shared folder from ``spark.checkpoint.dir``
and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.constants import DOMAIN, HIT_COLUMNS, KEYWORD, REVENUE
from clicklens.functions import has_text, hit_revenue, query_param, search_keyword, url_domain
from clicklens.operators import (
    exact_sum,
    with_attribution,
    external_search_hits,
    keyword_report,
    keyword_revenue,
    product_rows,
    purchase_hits,
    qualified_hits,
    revenue_by,
)
from clicklens.plans import SearchKeywordJob
from clicklens.session import scratch_path
from clicklens.sinks import dated_name, read_report_file, read_report_table, write_report_file, write_report_table
from clicklens.sinks.files import copy_over, matching
from clicklens.sources.derived import derived_hits, read_events
from clicklens.sources.schema import typed
from clicklens.sources.tsv import (
    WRITE_OPTIONS,
    hits_from_lines,
    read_hits,
    tsv_line,
    write_hits_tsv,
    write_lines,
)
from clicklens.streaming import incremental_report, read_running_revenue, running_revenue

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DATE = dt.date(2024, 1, 31)


# --- per-hit operators ------------------------------------------------------


def q_has_text(spark: SparkSession, sf: str) -> DataFrame:
    return derived_hits(spark, sf).select(
        "event_id",
        has_text("referrer").alias("referrer_has_text"),
        has_text("event_list").alias("event_list_has_text"),
        has_text("product_list").alias("product_list_has_text"),
    )


def q_referrer_domain(spark: SparkSession, sf: str) -> DataFrame:
    return derived_hits(spark, sf).select("event_id", url_domain("referrer").alias(DOMAIN))


def q_search_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return derived_hits(spark, sf).select("event_id", search_keyword("referrer").alias(KEYWORD))


def q_hit_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return derived_hits(spark, sf).select("event_id", hit_revenue("product_list").alias(REVENUE))


def q_hit_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """Every hit with all derived columns (the per-row step before filtering)."""
    return with_attribution(derived_hits(spark, sf)).select(
        "event_id", DOMAIN, KEYWORD, "is_external_search", "is_purchase", REVENUE
    )


def q_product_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = product_rows(derived_hits(spark, sf))
    return rows.withColumn("product_index", F.col("product_index").cast("bigint"))


def q_external_search_hits(spark: SparkSession, sf: str) -> DataFrame:
    return external_search_hits(derived_hits(spark, sf)).select("event_id", DOMAIN)


def q_external_search_hits_table(spark: SparkSession, sf: str) -> DataFrame:
    """The hosts are a table: those that purchases came from, in upper case and with ``www.``."""
    hits = derived_hits(spark, sf)
    hosts = purchase_hits(hits).select(F.upper(F.concat(F.lit("www."), url_domain("referrer"))).alias("host"))
    return external_search_hits(hits, hosts).select("event_id", DOMAIN)


def q_purchase_hits(spark: SparkSession, sf: str) -> DataFrame:
    return purchase_hits(derived_hits(spark, sf)).select("event_id", "event_list")


def q_qualified_hits(spark: SparkSession, sf: str) -> DataFrame:
    return qualified_hits(derived_hits(spark, sf), keep=("event_id",))


def q_keyword_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_revenue(derived_hits(spark, sf))


def q_keyword_report(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_report(derived_hits(spark, sf))


def q_report_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_revenue(derived_hits(spark, sf)).agg(F.count(F.lit(1)).alias("report_rows"))


# --- the same rules on the other provided tables ----------------------------


def q_pages_domain(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet")
    return pages.select("page_id", url_domain("url").alias("page_domain"))


def q_pages_query_param(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet")
    return pages.select(
        "page_id",
        query_param("url", "utm_source").alias("utm_source"),
        query_param("url", "page").alias("page"),
        query_param("url", "ref").alias("ref"),
    )


def q_events_by_type_revenue(spark: SparkSession, sf: str) -> DataFrame:
    events = read_events(spark, sf)
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return counts.join(revenue_by(events, ["event_type"], "value"), "event_type")


# --- sources: files written from the derived hits and read back -------------


def _hits_tsv(spark: SparkSession, sf: str, name: str) -> str:
    path = scratch_path(spark, name)
    write_hits_tsv(derived_hits(spark, sf).drop("event_id"), path)
    return path


def q_hits_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_hits(spark, _hits_tsv(spark, sf, "hits-scan"))


def q_hits_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Header reversed, names padded with spaces, one column absent; typed result."""
    hits = derived_hits(spark, sf).drop("event_id", "geo_city")
    padded = hits.select(*[F.col(c).alias(f" {c} ") for c in reversed(hits.columns)])
    path = scratch_path(spark, "hits-schema")
    write_hits_tsv(padded, path)
    return typed(read_hits(spark, path))


def q_hits_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = spark.read.text(_hits_tsv(spark, sf, "hits-lines"))
    return keyword_report(hits_from_lines(lines))


SHORT_ROW_ORDER = ("referrer", "event_list", "product_list") + tuple(
    c for c in HIT_COLUMNS if c not in ("referrer", "event_list", "product_list")
)


def q_hits_short_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Used columns first; some rows lack the last two fields, some have an extra
    field, some are followed by a blank line. Short rows must not count."""
    hits = derived_hits(spark, sf)
    eid = F.col("event_id")
    cols = [F.col(c) for c in SHORT_ROW_ORDER]
    line = (
        F.when(eid % 7 == 3, tsv_line(*cols[:-2]))
        .when(eid % 7 == 5, tsv_line(*cols, F.lit("extra")))
        .otherwise(tsv_line(*cols))
    )
    lines = hits.select(
        F.explode(F.when(eid % 11 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))).alias("line")
    )
    path = scratch_path(spark, "hits-short")
    write_lines(lines, "\t".join(SHORT_ROW_ORDER), path)
    return keyword_report(read_hits(spark, path))


def q_hits_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """One folder, three kinds of files: the usual header, a reversed and padded
    one, and one without ``geo_city`` but with a column of its own."""
    path = scratch_path(spark, "hits-mixed")
    hits = derived_hits(spark, sf)
    third = F.pmod("event_id", F.lit(3))
    usual = hits.where(third == 0).drop("event_id")
    padded = hits.where(third == 1).drop("event_id")
    padded = padded.select(*[F.col(c).alias(f" {c} ") for c in reversed(padded.columns)])
    absent = hits.where(third == 2).withColumn("own", F.lit("x")).drop("event_id", "geo_city")
    for name, part in (("usual", usual), ("padded", padded), ("absent", absent)):
        write_hits_tsv(part, f"{path}/{name}")
    return read_hits(spark, path)


def q_hits_multi_line(spark: SparkSession, sf: str) -> DataFrame:
    """Some user agents hold a line break and a tab inside quotes."""
    hits = derived_hits(spark, sf)
    broken = F.when(F.col("event_id") % 5 == 0, F.concat("user_agent", F.lit("\n\tsecond line"))).otherwise(F.col("user_agent"))
    path = scratch_path(spark, "hits-multi")
    write_hits_tsv(hits.withColumn("user_agent", broken).drop("event_id"), path)
    return read_hits(spark, path, multi_line=True)


def q_keyword_revenue_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Prices far apart on the same keys: nothing is dropped or rounded away."""
    eid = F.col("event_id")
    third = F.floor(eid / 10) % 3 == 0
    small = F.when(third, "A;B;1;1e400;,A;B;1;5;").otherwise("A;B;1;0.0000001;")
    large = F.when(third, "A;B;1;2e22;").otherwise("A;B;1;4.25;")
    kind = F.when(eid % 2 == 0, "small").otherwise("large")
    hits = derived_hits(spark, sf).withColumn("event_list", F.lit("1"))
    hits = hits.withColumn("product_list", F.when(kind == "small", small).otherwise(large))
    hits = hits.withColumn("referrer", F.concat(F.lit("http://bing.com/s?q="), kind, (eid % 10).cast("string")))
    out = keyword_revenue(hits)
    return out.select(DOMAIN, KEYWORD, F.format_string("%.9e", REVENUE).alias(REVENUE))


# --- sinks ------------------------------------------------------------------


def q_report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Whole job: TSV in, one dated report file out; the file read back."""
    job = SearchKeywordJob(
        input_path=_hits_tsv(spark, sf, "sink-in"),
        output_prefix=scratch_path(spark, "sink-out"),
        run_date=REPORT_DATE,
    )
    return read_report_file(spark, job.run(spark).output_file)


REVERSED_PARAMS = ("p", "q")
DAY_BEFORE = REPORT_DATE - dt.timedelta(days=1)


def _two_day_table(spark: SparkSession, sf: str) -> str:
    """Day before: a first run with other parameters, then a re-run (must replace it).
    Report day: the reversed-parameter run."""
    path = scratch_path(spark, "report-table")
    hits = derived_hits(spark, sf)
    write_report_table(keyword_revenue(hits, params=REVERSED_PARAMS), path, DAY_BEFORE)
    write_report_table(keyword_revenue(hits, params=REVERSED_PARAMS), path, REPORT_DATE)
    write_report_table(keyword_revenue(hits), path, DAY_BEFORE)
    return path


def q_report_rerun(spark: SparkSession, sf: str) -> DataFrame:
    return read_report_table(spark, _two_day_table(spark, sf))


def q_report_table(spark: SparkSession, sf: str) -> DataFrame:
    """Read one day back: the filter on run_date prunes to that partition."""
    return read_report_table(spark, _two_day_table(spark, sf), DAY_BEFORE)


def q_report_empty(spark: SparkSession, sf: str) -> DataFrame:
    """No referrer in the data is on this host list: a header-only file."""
    report = keyword_report(derived_hits(spark, sf), hosts=("search.example.invalid",))
    out = write_report_file(report, scratch_path(spark, "empty-out"), REPORT_DATE)
    return spark.read.text(out).withColumnRenamed("value", "line")


def q_report_line_break_keyword(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords that hold a line break, through the file and back."""
    hits = derived_hits(spark, sf)
    hits = hits.withColumn("referrer", F.replace("referrer", F.lit("q=oak+"), F.lit("q=oak%0A")))
    out = write_report_file(keyword_report(hits), scratch_path(spark, "break-out"), REPORT_DATE)
    return read_report_file(spark, out)


def _tsv(df: DataFrame, path: str) -> str:
    write_hits_tsv(df.drop("event_id"), path)
    return path


def q_report_rerun_empty(spark: SparkSession, sf: str) -> DataFrame:
    """The same day again, now without a qualifying hit: no rows stay in the
    table, and the file is a header."""
    hits, work = derived_hits(spark, sf), scratch_path(spark, "rerun-empty")
    full = _tsv(hits, f"{work}/full")
    none = _tsv(hits.where(F.col("event_list").isNull() | ~F.col("event_list").contains("1")), f"{work}/none")
    for source in (full, none):
        job = SearchKeywordJob(source, f"{work}/out", REPORT_DATE, table_path=f"{work}/table")
        out = job.run(spark).output_file
    left = read_report_table(spark, f"{work}/table", REPORT_DATE).count()
    return spark.read.text(out).select(F.col("value").alias("line"), F.lit(left).cast("bigint").alias("table_rows"))


def q_report_rerun_by_input(spark: SparkSession, sf: str) -> DataFrame:
    """Two inputs; one is corrected to no purchase and the day run again: its rows are gone."""
    hits, work = derived_hits(spark, sf), scratch_path(spark, "rerun-input")
    odd = hits.where(F.col("event_id") % 2 == 1)
    _tsv(odd, f"{work}/in/b")
    for first in (hits, hits.withColumn("event_list", F.lit("2"))):
        _tsv(first.where(F.col("event_id") % 2 == 0), f"{work}/in/a")
        job = SearchKeywordJob(f"{work}/in", f"{work}/out", REPORT_DATE, table_path=f"{work}/table", by_input=True)
        out = job.run(spark).output_file
    return read_report_file(spark, out)


def q_report_by_input_two_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two inputs of one day, each its own run: the table keeps both reports."""
    hits, work = derived_hits(spark, sf), scratch_path(spark, "two-inputs")
    for k in (0, 1):
        _tsv(hits.where(F.col("event_id") % 2 == k), f"{work}/in/{k}")
        SearchKeywordJob(f"{work}/in/{k}", f"{work}/out", REPORT_DATE, table_path=f"{work}/table", by_input=True).run(spark)
    rows = read_report_table(spark, f"{work}/table", REPORT_DATE, extra="input_file string")
    rows = rows.withColumn("input", F.regexp_extract("input_file", "/in/([01])/", 1))
    return rows.groupBy("input", DOMAIN, KEYWORD).agg(exact_sum(REVENUE).alias(REVENUE))


# --- streams ----------------------------------------------------------------


def _daily_files(spark: SparkSession, sf: str, path: str, days=None) -> str:
    """The derived hits as TSV files under day=YYYY-MM-DD/ folders, one file per day."""
    hits = derived_hits(spark, sf).drop("event_id").withColumn("day", F.substring("date_time", 1, 10))
    hits = hits if days is None else hits.where(days)
    hits.repartition("day").write.mode("append").options(**WRITE_OPTIONS).partitionBy("day").csv(path)
    return path


def q_incremental_report(spark: SparkSession, sf: str) -> DataFrame:
    """A report per arriving file, told apart by the day folder it came from; a
    second run finds nothing new."""
    src = _daily_files(spark, sf, scratch_path(spark, "daily-in"))
    table, ckpt = scratch_path(spark, "incr-table"), scratch_path(spark, "incr-ckpt")
    for _ in range(2):
        incremental_report(spark, src, table, ckpt, max_files_per_trigger=16).awaitTermination()
    per_file = read_report_table(spark, table, extra="input_file string")
    return per_file.select(F.regexp_extract("input_file", r"day=([0-9-]+)", 1).alias("day"), DOMAIN, KEYWORD, REVENUE)


def q_incremental_dated_file(spark: SparkSession, sf: str) -> DataFrame:
    """The dated file is the newest upload's report: here that of the last day, which arrives last."""
    path, out = scratch_path(spark, "dated-in"), scratch_path(spark, "dated-out")
    table, ckpt = scratch_path(spark, "dated-table"), scratch_path(spark, "dated-ckpt")
    last = derived_hits(spark, sf).agg(F.max(F.substring("date_time", 1, 10))).first()[0]
    for days in (F.col("day") < last, F.col("day") == last):
        _daily_files(spark, sf, path, days)
        incremental_report(spark, path, table, ckpt, output_prefix=out, run_date=REPORT_DATE).awaitTermination()
    return read_report_file(spark, f"{out}/{dated_name(REPORT_DATE)}")


def q_running_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals over every arriving file (several micro-batches, then a
    run with nothing new); equals the batch totals."""
    src = _daily_files(spark, sf, scratch_path(spark, "running-in"))
    table, ckpt = scratch_path(spark, "running-table"), scratch_path(spark, "running-ckpt")
    for _ in range(2):
        running_revenue(spark, src, table, ckpt, max_files_per_trigger=8).awaitTermination()
    return read_running_revenue(spark, table)


def q_running_revenue_reupload(spark: SparkSession, sf: str) -> DataFrame:
    """Files of even days are uploaded again under their names, a third of their
    hits without an event now: the totals follow."""
    work = scratch_path(spark, "reupload")
    src = _daily_files(spark, sf, f"{work}/in")
    running_revenue(spark, src, f"{work}/table", f"{work}/ckpt").awaitTermination()
    hits = derived_hits(spark, sf)
    hits = hits.withColumn("event_list", F.when(F.col("event_id") % 3 != 0, F.col("event_list")))
    fixed = hits.drop("event_id").withColumn("day", F.substring("date_time", 1, 10)).where(F.substring("day", 9, 2).cast("int") % 2 == 0)
    fixed.repartition("day").write.options(**WRITE_OPTIONS).partitionBy("day").csv(f"{work}/fixed")
    for new in matching(spark, f"{work}/fixed/day=*/part-*"):
        folder = new.split("/")[-2]
        copy_over(spark, new, matching(spark, f"{src}/{folder}/part-*")[0])
    running_revenue(spark, src, f"{work}/table", f"{work}/ckpt").awaitTermination()
    return read_running_revenue(spark, f"{work}/table")


QUERIES: dict[str, Query] = {
    "has_text": q_has_text,
    "referrer_domain": q_referrer_domain,
    "search_keyword": q_search_keyword,
    "hit_revenue": q_hit_revenue,
    "hit_attribution": q_hit_attribution,
    "product_rows": q_product_rows,
    "external_search_hits": q_external_search_hits,
    "external_search_hits_table": q_external_search_hits_table,
    "purchase_hits": q_purchase_hits,
    "qualified_hits": q_qualified_hits,
    "keyword_revenue": q_keyword_revenue,
    "keyword_report": q_keyword_report,
    "report_row_count": q_report_row_count,
    "pages_domain": q_pages_domain,
    "pages_query_param": q_pages_query_param,
    "events_by_type_revenue": q_events_by_type_revenue,
    "hits_scan": q_hits_scan,
    "hits_schema": q_hits_schema,
    "hits_from_lines": q_hits_from_lines,
    "hits_short_rows": q_hits_short_rows,
    "hits_mixed_headers": q_hits_mixed_headers,
    "hits_multi_line": q_hits_multi_line,
    "keyword_revenue_extremes": q_keyword_revenue_extremes,
    "report_sink": q_report_sink,
    "report_rerun": q_report_rerun,
    "report_table": q_report_table,
    "report_empty": q_report_empty,
    "report_rerun_empty": q_report_rerun_empty,
    "report_rerun_by_input": q_report_rerun_by_input,
    "report_by_input_two_files": q_report_by_input_two_files,
    "report_line_break_keyword": q_report_line_break_keyword,
    "incremental_report": q_incremental_report,
    "incremental_dated_file": q_incremental_dated_file,
    "running_revenue": q_running_revenue,
    "running_revenue_reupload": q_running_revenue_reupload,
}
