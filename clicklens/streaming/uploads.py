"""What a stream of uploads keeps: a log of steps, and the files that changed since.

``Log`` is a folder of small steps, each written whole or not at all. Every
``FOLD_EVERY`` steps they are folded into one, sorted by upload time, so the
number of files grows by one in ``FOLD_EVERY`` batches, no row is written more
than twice, and a reader that asks for late uploads skips the earlier folds by
their statistics.

``Changes`` finds files uploaded again. Its first listing is of all files;
later ones look at files modified since the newest one seen, a ``SLACK`` before
it included (a store may date a file by the beginning of its upload), and come
at most every ``RELIST_SECONDS``.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.sinks.files import child, exists, listed, remove
from clicklens.sinks.report_table import plain_path, replace_folder

FOLD_EVERY = 50
SLACK = dt.timedelta(days=1)
RELIST_SECONDS = 60
#: Listed files up to this number are sent to every task.
FEW_FILES = 200_000

Upload = tuple[str, dt.datetime]


class Log:
    """Steps and folds of rows; ``schema`` has ``path`` and ``mtime``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _numbered(self, kind: str) -> list[tuple[int, str]]:
        names = (p.rpartition("/")[2] for p in (listed(self.spark, self.path) if exists(self.spark, self.path) else []))
        return sorted((int(n.partition("=")[2].split("-")[0]), child(self.path, n)) for n in names if n.startswith(f"{kind}="))

    def steps(self) -> list[tuple[int, str]]:
        """Steps that no fold holds, in order."""
        folded = max((n for n, _ in self._numbered("fold")), default=-1)
        return [s for s in self._numbered("step") if s[0] > folded]

    def rows(self, after: int | None = None) -> DataFrame:
        """All rows, or those of the steps after a number that the last fold doesn't pass."""
        steps = self.steps()
        parts = [p for _, p in self._numbered("fold") + steps] if after is None else [p for n, p in steps if n > after]
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else self.spark.createDataFrame([], self.schema)

    def last(self) -> int:
        return max((n for kind in ("fold", "step") for n, _ in self._numbered(kind)), default=-1)

    def add(self, rows: DataFrame) -> None:
        # The mark keeps steps of two streams apart.
        replace_folder(rows, self.path, f"step={self.last() + 1}-{uuid.uuid4().hex[:8]}")

    def full(self) -> bool:
        return len(self.steps()) >= FOLD_EVERY

    def fold(self) -> None:
        """The open steps become one fold."""
        steps = self.steps()
        rows = self.spark.read.schema(self.schema).parquet(*[p for _, p in steps])
        replace_folder(rows.repartitionByRange("mtime").sortWithinPartitions("mtime"), self.path, f"fold={steps[-1][0]}")
        for _, p in steps:
            remove(self.spark, p)

    def unknown(self, uploads: list[Upload]) -> list[Upload]:
        """Those of a micro-batch's uploads that the log doesn't hold."""
        if not uploads or not exists(self.spark, self.path):
            return sorted(set(uploads))
        since = min(m for _, m in uploads)
        known = self.rows().where(F.col("mtime") >= F.lit(since)).select("path", "mtime")
        given = self.spark.createDataFrame(uploads, "path string, mtime timestamp")
        # A micro-batch's files are few: they go to the log, not the log to them.
        known = known.join(F.broadcast(given), ["path", "mtime"], "left_semi").distinct()
        return sorted(set(uploads) - {(r["path"], r["mtime"]) for r in known.collect()})


class Changes:
    """Files of a folder that were uploaded again after the log's entry of them."""

    def __init__(self, log: Log, folder: str):
        self.log, self.folder = log, folder
        self.newest: dt.datetime | None = None
        self.listed_at: float | None = None

    def due(self) -> bool:
        return self.listed_at is None or time.monotonic() - self.listed_at >= RELIST_SECONDS

    def find(self) -> list[Upload]:
        self.listed_at = time.monotonic()
        spark = self.log.spark
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.folder)
        files = files.select(plain_path(F.col("path")).alias("path"), "modificationTime")
        if self.newest is not None:
            files = files.where(F.col("modificationTime") > F.lit(self.newest - SLACK))
        found = files.agg(F.count(F.lit(1)).alias("n"), F.max("modificationTime").alias("newest")).first()
        if not found["n"]:
            return []
        self.newest = found["newest"] if self.newest is None else max(self.newest, found["newest"])
        few = F.broadcast(files) if found["n"] <= FEW_FILES else files
        done = self.log.rows().select("path", "mtime").join(few, "path").groupBy("path", "modificationTime").agg(F.max("mtime").alias("done"))
        again = done.where(F.col("modificationTime") > F.col("done"))
        # Files uploaded again since the last look, as a micro-batch of their own.
        return [(r["path"], r["modificationTime"]) for r in again.collect()]
