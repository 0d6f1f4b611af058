"""Write PLANS.md: physical-plan shape of every registered query.

Usage: python tools/plan_report.py [SF_DIR] > PLANS.md
Each query is run once with AQE on; counts come from its final plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiframe.queries import registry  # noqa: E402
from kpiframe.plans.inspect import explain_text, forbidden_nodes  # noqa: E402
from kpiframe.session import local_session  # noqa: E402

TABLES = ("orders", "customer", "nation", "region", "lineitem", "events")


def final_plan(df) -> tuple[str, str]:
    """The tree of the plan as it ran, and the details of its nodes only."""
    df.collect()
    text = explain_text(df)
    tree, _, details = text.partition("\n\n\n")
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    ran = set(re.findall(r"\((\d+)\)\s*$", tree, flags=re.M))
    nodes = re.split(r"\n(?=\(\d+\) )", "\n" + details.lstrip("\n"))
    return tree, "\n".join(n for n in nodes if (m := re.match(r"\((\d+)\) ", n)) and m[1] in ran)


def node_count(tree: str, node: str) -> int:
    return len(re.findall(rf"(?<![A-Za-z]){node} ?\(\d+\)", tree))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` from the final plans of a run at `{sf}`, AQE on.")
    print("Broadcasts here are the planner's own size decisions at this scale; at 100 TB the fact-side")
    print("joins become shuffle joins. Reused exchanges are counted apart.\n")
    print("| query | scans | exchanges | reused | broadcasts | windows | pushed range/IN filters | forbidden nodes |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in registry.queries().items():
        tree, text = final_plan(fn(spark, sf))
        scans = []
        for t in TABLES:
            n = len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{t}\.parquet\]", text))
            if n:
                scans.append(f"{t}×{n}")
        pushed = set()
        for f in re.findall(r"PushedFilters: \[(.*)\]", text):
            for m in re.finditer(r"(GreaterThanOrEqual|LessThan|In|EqualTo|Not\(In)\((\w+)", f):
                pushed.add(f"{m.group(1).replace('Not(In', 'NotIn')}({m.group(2)})")
        print(f"| `{name}` | {', '.join(scans)} | {node_count(tree, 'Exchange')} | "
              f"{node_count(tree, 'ReusedExchange')} | {node_count(tree, 'BroadcastExchange')} | {node_count(tree, 'Window')} | "
              f"{', '.join(sorted(pushed)) or '–'} | {', '.join(forbidden_nodes(text)) or 'none'} |")


if __name__ == "__main__":
    main()
