"""Execute the headline queries and record their final (AQE) physical plans.

    python tools/explain_plans.py [sf_dir] > docs/PLANS.md
    python tools/explain_plans.py --at-scale [sf_dir] > docs/PLANS_AT_SCALE.md

``--at-scale`` switches off size-based broadcasting (static and AQE), as when
every table is too big to broadcast: only the broadcasts behind a counted
bound remain, and every other join shows the shuffle it would use at scale.

For each query: counts of shuffles, broadcasts and join strategies in the
final plan, the pushed scan filters, then the plan itself.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from torque.catalog import QUERIES  # noqa: E402
from torque.session import get_session  # noqa: E402

HEADLINE = ["etl_car_sales", "fact_sales", "dim_car_detail", "dim_car_detail_semi", "merge_replace",
            "merge_cumulative", "update_only", "dedupe_last_write", "extract_changed",
            "delete_by_key", "fk_violations", "reconcile_etl_elt"]
COUNTS = ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange",
          "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
          "HashAggregate", "SortAggregate", "Window", "EvalPython"]


def final_only(tree: str) -> str:
    """Drop every "== Initial Plan ==" block (AQE prints the plan it started
    from under the final one, also inside subqueries), so counts are of the
    plan that ran."""
    out, skip_deeper_than = [], None
    for line in tree.splitlines():
        indent = len(line) - len(line.lstrip(" :+-|"))
        if skip_deeper_than is not None:
            if indent >= skip_deeper_than:
                continue
            skip_deeper_than = None
        if "== Initial Plan ==" in line:
            skip_deeper_than = indent
            continue
        out.append(line)
    return "\n".join(out)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    at_scale = "--at-scale" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.1"
    extra = {"spark.sql.maxMetadataStringLength": "2000"}
    if at_scale:
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = get_session("local[8]", 16, extra=extra)
    if at_scale:
        print(f"# Physical plans with size-based broadcasting off ({os.path.basename(sf)}, local[8])\n")
        print("Generated by `tools/explain_plans.py --at-scale`. Static and AQE broadcast thresholds are "
              "off, as if every table were too big to broadcast. The remaining broadcasts are the ones "
              "behind a counted bound (batch keys, changed ids, currencies, the rates snapshot). Every "
              "other join shows the shuffle it uses at scale.\n")
    else:
        print(f"# Final physical plans at {os.path.basename(sf)} (local[8], AQE on)\n")
        print("Generated by `tools/explain_plans.py`; plans are taken after execution, so they show "
              "AQE's runtime choices (broadcasts from measured sizes, coalesced partitions).\n")
    for key in HEADLINE:
        df = QUERIES[key](spark, sf)
        # An action on the DataFrame's own query execution finalises its
        # adaptive plan (a separate write would run a different execution).
        df.toArrow()
        plan = final_only(df._jdf.queryExecution().executedPlan().toString())
        counts = {c: plan.count(c) for c in COUNTS if plan.count(c)}
        pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)) - {""})
        print(f"## {key}\n")
        print("| operator | count |\n|---|---|")
        for c, n in counts.items():
            print(f"| {c} | {n} |")
        print()
        for p in pushed:
            print(f"* PushedFilters: `{p[:400]}`")
        print("\n```")
        for line in df._jdf.queryExecution().executedPlan().treeString().splitlines():
            print(line[:240])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
