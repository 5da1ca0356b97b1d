"""A report survives failed tasks: same file, same row count as a clean run."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(
    """
    import datetime as dt, sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import Observation, SparkSession, functions as F
    from clicklens.operators import keyword_revenue, labelled
    from clicklens.sinks import write_report_file
    from clicklens.sources.derived import derived_hits

    spark = (SparkSession.builder.master("local[4,3]")  # a task may run up to 3 times
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clicklens-resil-")).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("boolean")
    def fail_first_attempt(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("injected task failure")
        return True

    flaky = fail_first_attempt.asNondeterministic()
    out = []
    for inject in (False, True):
        hits = derived_hits(spark, {sf!r}).repartition(4)
        if inject:
            hits = hits.where(flaky(F.lit(1)))
        agg = labelled(keyword_revenue(hits))
        if inject:
            agg = agg.where(flaky(F.lit(2)))
        obs = Observation("rows")
        path = write_report_file(agg, tempfile.mkdtemp(prefix="clicklens-resil-out-"), dt.date(2024, 1, 1), obs)
        out.append((open(path.replace("file:", ""), "rb").read(), obs.get["rows"]))
    assert out[0] == out[1], out
    print("SAME", out[0][1])
    """
)


def test_report_survives_failed_tasks(tmp):
    script = SCRIPT.format(root=ROOT, sf=SF_SMALL)
    env = dict(os.environ, PYTHONPATH=ROOT)
    res = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, env=env)
    assert res.returncode == 0, res.stderr[-3000:]
    assert "SAME" in res.stdout
