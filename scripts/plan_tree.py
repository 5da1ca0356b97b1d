"""Print the executed operator tree of the report (node names only).

Usage: python scripts/plan_tree.py [sf_dir]
Writes the derived hit log as TSV under spark.checkpoint.dir, runs
``keyword_report(read_input(...))`` and walks the final adaptive plan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicklens.operators import keyword_report  # noqa: E402
from clicklens.plans import read_input  # noqa: E402
from clicklens.session import local_session, scratch_path  # noqa: E402
from clicklens.sources.derived import derived_hits  # noqa: E402
from clicklens.sources.tsv import write_hits_tsv  # noqa: E402


def walk(node, depth: int = 0) -> None:
    name = node.nodeName()
    extra = ""
    if name == "Exchange":
        extra = " " + str(node.outputPartitioning()).split("(")[0]
    elif "Scan" in name:
        extra = " ReadSchema=" + str(node.requiredSchema().simpleString())
    elif name == "WholeStageCodegen":
        extra = f" *({node.codegenStageId()})"
    print("  " * depth + name + extra)
    if name == "AdaptiveSparkPlan":
        kids = [node.executedPlan()]
    elif "QueryStage" in name:
        kids = [node.plan()]
    else:
        children = node.children()
        kids = [children.apply(i) for i in range(children.size())]
    for kid in kids:
        walk(kid, depth + 1)


def main(argv: list[str]) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    path = scratch_path(spark, "plan-in")
    write_hits_tsv(derived_hits(spark, sf).drop("event_id"), path)
    report = keyword_report(read_input(spark, path))
    report.collect()
    walk(report._jdf.queryExecution().executedPlan())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
