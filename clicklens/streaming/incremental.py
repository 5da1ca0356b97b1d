"""New-file processing with Structured Streaming.

Both streams are streams of *files* (path and modification time, one small row
each); a micro-batch reads its files with ``read_hits``, each by its own
header. They are checkpointed: a restart resumes after the last committed
batch, and a run with no new file does nothing.

``incremental_report``: every upload yields its own report, kept in a table
under its day and file, and the day's newest upload as the dated file (header
only where none of its hits qualifies). The day is the upload's modification
date (UTC) unless given. A ledger beside the table lists what was processed,
by path and modification time: a replayed batch, or another stream into the
same table, finds its uploads done and changes nothing, and a file uploaded
again under its name is processed again. A file whose content cannot be read
is noted in the ledger with its error and does not stop the others. Any other
fault (a lost executor, a store that does not answer) is tried ``ATTEMPTS``
times and then fails the batch, which runs again when the stream is started
again: no upload is given up for it.

``running_revenue``: totals over the newest upload of every file so far. Each
step logs its uploads' own sums and, for a file uploaded again, the sums that
it had before with the sign turned, so the totals follow corrections. An
upload that the log holds is not added again (replayed batches, a stream with
a new checkpoint). Totals of many steps are kept as one table, so a read sees
that and a bounded tail of steps however long the stream runs. Files whose
content cannot be read are set aside with their error and the others counted;
what such a file held before stays. One stream at a time writes to a table.

The logs are ``uploads.Log``s: a batch reads what is as late as its own files.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklens.constants import (
    DOMAIN,
    KEYWORD,
    KEYWORD_PARAMS,
    PURCHASE_EVENT,
    REVENUE,
    SEARCH_ENGINE_HOSTS,
)
from clicklens.operators import exact_sum, keyword_revenue, labelled
from clicklens.sinks import read_report_table, write_report_file
from clicklens.sinks.files import child, exists, listed, move, remove
from clicklens.sinks.report_table import SCHEMA, part_name, plain_path, replace_folder
from clicklens.sources.tsv import read_hits, read_hits_stream
from clicklens.streaming.uploads import Changes, Log, Upload

LEDGER = "path string, mtime timestamp, run_date date, error string"
#: A row per upload (no domain; its error, if any), and its sums by pair: sign 1, or -1 where they are taken back.
SUMS = f"path string, mtime timestamp, error string, {SCHEMA}, sign int"
TOTALS = f"{SCHEMA}, uploads long"
#: Times that work is tried where a fault may pass.
ATTEMPTS = 3

def of_the_data(error: Exception) -> bool:
    """Whether a file's content is at fault (or the file is gone), so that trying again is of no use."""
    return isinstance(error, FileNotFoundError) or any(mark in str(error) for mark in _DATA_FAULTS)


_DATA_FAULTS = ("USER_RAISED_EXCEPTION", "MALFORMED_", "PATH_NOT_FOUND", "FILE_NOT_EXIST", "not in GZIP format", "incorrect header check", "ZipException")


def read_ledger(spark: SparkSession, table_path: str) -> DataFrame:
    """Processed uploads: path, modification time, day, and the error of those that could not be read."""
    return Log(spark, child(table_path, "_ledger"), LEDGER).rows()


def set_aside(files: list, work: Callable[[tuple], None]) -> dict[str, str]:
    """Does ``work`` for each file (a tuple that begins with its path); errors of those whose content is at fault.

    Other faults are raised after ``ATTEMPTS`` tries.
    """
    errors: dict[str, str] = {}
    for one in files:
        for attempt in range(1, ATTEMPTS + 1):
            try:
                work(one)
                break
            except (PySparkException, FileNotFoundError) as e:
                if of_the_data(e):
                    errors[one[0]] = str(e)[:2000]
                    break
                if attempt == ATTEMPTS:
                    raise
    return errors


class _Reports:
    """Processes uploads into the report table, the ledger and the dated files."""

    def __init__(self, spark: SparkSession, table_path: str, output_prefix: str | None, run_date: dt.date | None, multi_line: bool, rules: dict):
        self.spark, self.table, self.prefix, self.run_date = spark, table_path, output_prefix, run_date
        self.multi_line, self.rules = multi_line, rules
        self.log = Log(spark, child(table_path, "_ledger"), LEDGER)

    def _days(self, uploads: list[Upload]) -> list[dt.date]:
        """Day of each upload, in the session's time zone."""
        if not uploads or self.run_date:
            return [self.run_date] * len(uploads)
        rows = self.spark.createDataFrame([(i, m) for i, (_, m) in enumerate(uploads)], "i int, mtime timestamp")
        return [r["day"] for r in sorted(rows.select("i", F.to_date("mtime").alias("day")).collect())]

    def process(self, uploads: list[Upload]) -> None:
        """``uploads`` is a micro-batch's list of files; those in the ledger are left alone."""
        new = self.log.unknown(uploads)
        todo = [(p, m, self.run_date or d) for (p, m), d in zip(new, self._days(new), strict=True)]
        if not todo:
            return
        try:
            self._write(todo)
            errors: dict[str, str] = {}
        except (PySparkException, FileNotFoundError):
            errors = set_aside(todo, lambda one: self._write([one]))
        if self.prefix is not None:
            self._publish([t for t in todo if t[0] not in errors])
        rows = [(p, m, d, errors.get(p)) for p, m, d in todo]
        self.log.add(self.spark.createDataFrame(rows, LEDGER).coalesce(1))
        if self.log.full():
            self.log.fold()

    def _write(self, todo: list) -> None:
        """Each upload's rows replace what its day and file held."""
        hits = read_hits(self.spark, [t[0] for t in todo], multi_line=self.multi_line, with_input_file=True)
        hits = hits.withColumn("input_file", plain_path(F.col("input_file")))
        agg = keyword_revenue(hits, extra_keys=("input_file",), **self.rules)
        days = self.spark.createDataFrame([(p, d.isoformat(), part_name(p)) for p, _, d in todo], "input_file string, run_date string, part string")
        stage = child(self.table, f"_stage-{hashlib.sha256(repr(todo).encode()).hexdigest()[:12]}")
        # ``days`` has a row per file of the micro-batch.
        agg.join(F.broadcast(days), "input_file").write.mode("overwrite").partitionBy("run_date", "part").parquet(stage)
        for path, _, day in todo:
            at = f"run_date={day.isoformat()}/part={part_name(path)}"
            remove(self.spark, child(self.table, at))
            if exists(self.spark, child(stage, at)):
                move(self.spark, child(stage, at), child(self.table, at))
        remove(self.spark, stage)

    def _publish(self, done: list) -> None:
        """The dated file of each day whose newest upload is among ``done``."""
        ledger = read_ledger(self.spark, self.table).where(F.col("error").isNull())
        for day in sorted({d for _, _, d in done}):
            mine = max((m, p) for p, m, d in done if d == day)
            before = ledger.where(F.col("run_date") == F.lit(day)).agg(F.max("mtime")).first()[0]
            if before is not None and before > mine[0]:
                continue
            rows = read_report_table(self.spark, self.table, day, extra="input_file string")
            mine_only = rows.where(F.col("input_file") == F.lit(mine[1])).select(DOMAIN, KEYWORD, REVENUE)
            write_report_file(labelled(mine_only), self.prefix, day)


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def _uploads(batch: DataFrame) -> list[Upload]:
    """The files of a micro-batch; ``max_files_per_trigger`` bounds them."""
    rows = batch.select(plain_path(F.col("path")).alias("path"), "modificationTime").collect()
    return [(r["path"], r["modificationTime"]) for r in rows]


def incremental_report(
    spark: SparkSession,
    input_dir: str,
    table_path: str,
    checkpoint_path: str,
    *,
    output_prefix: str | None = None,
    run_date: dt.date | None = None,
    max_files_per_trigger: int | None = 1000,
    available_now: bool = True,
    multi_line: bool = False,
    hosts: Sequence[str] = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
) -> StreamingQuery:
    """Start the per-upload report stream; with ``available_now`` it stops when caught up.

    Files uploaded again are processed at the start and then with the batches, at
    most every ``uploads.RELIST_SECONDS``.
    """
    rules = {"hosts": hosts, "params": params, "purchase_event": purchase_event}
    reports = _Reports(spark, table_path, output_prefix, run_date, multi_line, rules)
    return _follow(reports, input_dir, checkpoint_path, max_files_per_trigger, available_now)


def _follow(work, input_dir: str, checkpoint_path: str, max_files_per_trigger: int | None, available_now: bool) -> StreamingQuery:
    """Streams the folder's uploads, new and changed, into ``work.process``."""
    changes = Changes(work.log, input_dir)
    if exists(work.spark, work.log.path):
        work.process(changes.find())

    def handle(batch: DataFrame, epoch_id: int) -> None:
        work.process(_uploads(batch))
        if changes.due():
            work.process(changes.find())

    stream = read_hits_stream(work.spark, input_dir, max_files_per_trigger=max_files_per_trigger)
    return _start(stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path), available_now)


# ----------------------------------------------------------- running totals


class _Totals:
    """Adds uploads to the log of sums, and folds its steps into the totals."""

    def __init__(self, spark: SparkSession, table_path: str, multi_line: bool = False, rules: dict | None = None):
        self.spark, self.table, self.multi_line, self.rules = spark, table_path, multi_line, rules or {}
        self.log = Log(spark, child(table_path, "_sums"), SUMS)

    def process(self, uploads: list[Upload]) -> None:
        """``uploads`` is a micro-batch's list of files; of a file listed twice the newest counts."""
        todo = sorted({p: m for p, m in sorted(self.log.unknown(uploads))}.items())
        if not todo:
            return
        before = self._before(todo)
        # Of an earlier version that a replay brings, the later one's sums stand.
        todo = [(p, m) for p, m in todo if p not in before or m > before[p]]
        try:
            self._add(todo, before, {})
        except (PySparkException, FileNotFoundError):
            errors = set_aside(todo, lambda one: self._sums([one[0]]).write.format("noop").mode("overwrite").save())
            self._add(todo, before, errors)
        if self.log.full():
            self.fold()

    def _before(self, todo: list[Upload]) -> dict[str, dt.datetime]:
        """The version that counts so far, of those files that have one."""
        given = F.broadcast(self.spark.createDataFrame(todo, "path string, _given timestamp"))
        rows = self.log.rows().where(F.col(DOMAIN).isNull() & F.col("error").isNull()).join(given, "path")
        return {r["path"]: r["mtime"] for r in rows.groupBy("path").agg(F.max("mtime").alias("mtime")).collect()}

    def _sums(self, paths: list[str]) -> DataFrame:
        hits = read_hits(self.spark, paths, multi_line=self.multi_line, with_input_file=True)
        return keyword_revenue(hits.withColumn("input_file", plain_path(F.col("input_file"))), extra_keys=("input_file",), **self.rules)

    def _add(self, todo: list[Upload], before: dict[str, dt.datetime], errors: dict[str, str]) -> None:
        good = [(p, m) for p, m in todo if p not in errors]
        marks = [(p, m, errors.get(p), None, None, None, 1) for p, m in todo]
        rows = self.spark.createDataFrame(marks, SUMS)
        if good:
            # Both lists have a row per file of the micro-batch.
            given = F.broadcast(self.spark.createDataFrame(good, "input_file string, mtime timestamp"))
            sums = self._sums([p for p, _ in good]).join(given, "input_file")
            rows = rows.unionByName(sums.select(F.col("input_file").alias("path"), "mtime", F.lit(None).cast("string").alias("error"), DOMAIN, KEYWORD, REVENUE, F.lit(1).alias("sign")))
        if again := [(p, before[p]) for p, _ in good if p in before]:
            old = F.broadcast(self.spark.createDataFrame(again, "path string, mtime timestamp"))
            back = self.log.rows().where(F.col(DOMAIN).isNotNull() & (F.col("sign") == 1)).join(old, ["path", "mtime"], "left_semi")
            rows = rows.unionByName(back.withColumn("sign", F.lit(-1)))
        self.log.add(rows.coalesce(8))

    def _newest(self) -> int:
        names = (p.rpartition("/")[2] for p in listed(self.spark, self.table)) if exists(self.spark, self.table) else ()
        return max((int(n.partition("=")[2]) for n in names if n.startswith("totals=")), default=-1)

    def totals(self) -> DataFrame:
        """Revenue of each pair, and in how many files it stands; pairs that stand in none are left out."""
        newest = self._newest()
        tail = self.log.rows(after=newest).where(F.col(DOMAIN).isNotNull())
        rows = tail.select(DOMAIN, KEYWORD, (F.col(REVENUE) * F.col("sign")).alias(REVENUE), F.col("sign").cast("long").alias("uploads"))
        if newest >= 0:
            rows = rows.unionByName(self.spark.read.schema(TOTALS).parquet(child(self.table, f"totals={newest}")))
        sums = rows.groupBy(DOMAIN, KEYWORD).agg(exact_sum(REVENUE).alias(REVENUE), F.sum("uploads").alias("uploads"))
        return sums.where(F.col("uploads") > 0)

    def fold(self) -> None:
        """The open steps go into new totals, then into a fold of the log: a fault between leaves both right."""
        old, last = self._newest(), self.log.last()
        replace_folder(self.totals(), self.table, f"totals={last}")
        if old >= 0:
            remove(self.spark, child(self.table, f"totals={old}"))
        self.log.fold()


def read_set_aside(spark: SparkSession, table_path: str) -> DataFrame:
    """Uploads that the running totals could not read: path and error."""
    return _Totals(spark, table_path).log.rows().where(F.col("error").isNotNull()).select("path", "error")


def read_running_revenue(spark: SparkSession, table_path: str) -> DataFrame:
    """Running total of each (domain, keyword); no rows before the first batch."""
    return _Totals(spark, table_path).totals().select(DOMAIN, KEYWORD, REVENUE)


def running_revenue(
    spark: SparkSession,
    input_dir: str,
    table_path: str,
    checkpoint_path: str,
    *,
    max_files_per_trigger: int | None = 1000,
    available_now: bool = True,
    multi_line: bool = False,
    hosts: Sequence[str] = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
) -> StreamingQuery:
    """Running (domain, keyword, revenue) over the newest upload of every file so far, in
    ``table_path`` (read it with ``read_running_revenue``)."""
    rules = {"hosts": hosts, "params": params, "purchase_event": purchase_event}
    return _follow(_Totals(spark, table_path, multi_line, rules), input_dir, checkpoint_path, max_files_per_trigger, available_now)
