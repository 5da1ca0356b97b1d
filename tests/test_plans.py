"""Plan properties that matter at scale, read from the executed plan."""

from __future__ import annotations

import re

from clicklens.operators import keyword_revenue
from clicklens.plans import read_input
from clicklens.sources.derived import derived_hits
from clicklens.sources.tsv import write_hits_tsv
from tests.conftest import SF_SMALL


def executed(df):
    """The final (adaptive) physical plan, after running the frame's own query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_report_plan_shape(spark, tmp):
    write_hits_tsv(derived_hits(spark, SF_SMALL).drop("event_id"), f"{tmp}/in")
    agg = keyword_revenue(read_input(spark, f"{tmp}/in"))
    plan = executed(agg)
    # Lines are split next to the scan; only the fields that the rules use are taken.
    assert "ReadSchema: struct<value:string>" in plan
    assert len(set(re.findall(r"_plain#\d+, (\d+)\]|_plain#\d+\[(\d+)\]", plan))) <= 3
    # One hash shuffle on the report keys, fed by a map-side partial sum.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    # Nothing is broadcast.
    assert "Broadcast" not in plan
    # The per-hit filter sits in a whole-stage-codegen stage next to the scan.
    assert re.search(r"\*\(\d+\) Filter", plan), plan[:2000]


def test_report_table_read_prunes_partitions(spark, tmp):
    import datetime as dt

    from clicklens.sinks import read_report_table, write_report_table

    agg = keyword_revenue(derived_hits(spark, SF_SMALL))
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2)):
        write_report_table(agg, f"{tmp}/t", day)
    one = read_report_table(spark, f"{tmp}/t", dt.date(2024, 1, 2))
    plan = executed(one)
    assert re.search(r"PartitionFilters: \[[^\]]*run_date", plan)
    assert one.count() == agg.count()


def _nodes(node):
    """All nodes of an executed (adaptive) plan, stages included."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        kids = [node.executedPlan()]
    elif "QueryStage" in name:
        kids = [node.plan()]
    else:
        children = node.children()
        kids = [children.apply(i) for i in range(children.size())]
    out = [node]
    for k in kids:
        out.extend(_nodes(k))
    return out


def test_hot_key_costs_one_shuffle_row_per_task(spark):
    """A third of all hits on one (domain, keyword): the shuffle still carries
    at most one row per key per map task, thanks to the map-side partial sum."""
    from pyspark.sql import functions as F

    hits = derived_hits(spark, "/root/testdata/sf0.01").repartition(8)
    hot = F.col("event_id") % 3 == 0
    skewed = hits.withColumn(
        "referrer", F.when(hot, F.lit("http://www.google.com/search?q=hot")).otherwise(F.col("referrer"))
    ).withColumn("event_list", F.when(hot, F.lit("1")).otherwise(F.col("event_list")))
    agg = keyword_revenue(skewed)
    rows = agg.collect()
    keys = len(rows)
    assert any(r["search_keyword"] == "hot" for r in rows)
    exchanges = [
        n for n in _nodes(agg._jdf.queryExecution().executedPlan())
        if n.nodeName() == "Exchange" and "hashpartitioning" in str(n.outputPartitioning())
    ]
    assert len(exchanges) == 1
    written = exchanges[0].metrics().get("shuffleRecordsWritten").get().value()
    map_tasks = 8
    assert 0 < written <= keys * map_tasks
    # Far fewer than the hot key's hits alone.
    assert written < skewed.where(hot).count() / 10
