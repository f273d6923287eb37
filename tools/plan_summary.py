"""Summarize the physical plans of the reports: shuffles, broadcasts, aggregates, joins.

Usage: python tools/plan_summary.py [sf_dir]
Prints a markdown table (counts of operators in the final adaptive plan, after
runtime re-planning and exchange reuse). Reused stages count under "reused".
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendlens.config import testing  # noqa: E402
from spendlens.plans import registry  # noqa: E402
from spendlens.session import get_spark  # noqa: E402
from spendlens.sources.catalog import fixture_catalog  # noqa: E402

REPORTS = ("report_sea", "report_display", "report_social", "report_affiliate", "report_branding",
           "report_seasonal_cost")
OPS = {
    "shuffle": r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning",
    "broadcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "HashAggregate": r"HashAggregate\(",
    "SortAggregate": r"SortAggregate\(",
    "BroadcastHashJoin": r"BroadcastHashJoin",
    "SortMergeJoin": r"SortMergeJoin",
    "NestedLoop/Cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "Window": r"\bWindow \[",
    "Generate(explode)": r"Generate explode",
    "PythonUDF": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas",
}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    cfg = testing()
    b = registry.builders()
    print("| report | " + " | ".join(OPS) + " |")
    print("|---|" + "---:|" * len(OPS))
    for k in REPORTS:
        df = b[k](fixture_catalog(spark, sf_dir), cfg)
        df.collect()  # runs the Dataset's own query execution, so its AQE plan is final
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        lines = plan.split("\n")
        counts = []
        for name, pat in OPS.items():
            if name == "reused":
                counts.append(sum(1 for ln in lines if "ReusedExchange" in ln))
            else:  # a reused stage is listed once, under "reused"
                counts.append(sum(len(re.findall(pat, ln)) for ln in lines if "ReusedExchange" not in ln))
        print(f"| {k} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main()
