"""Print a markdown table of plan facts for every registered query (after execution, AQE final plans).

usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from imlens.plans.queries import QUERIES  # noqa: E402
from imlens.session import local_session  # noqa: E402

SKIP = {"classify_gbt", "classify_rf"}


def facts(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", final)
    return {
        "shuffles": len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final))
        - len(re.findall(r"ReusedExchange \[[^\]]*\], Exchange", final)),
        "broadcasts": final.count("BroadcastExchange"),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas", final)),
        "columns read": "; ".join(sorted({s for s in schemas})) or "-",
        "cartesian": "yes" if ("CartesianProduct" in final or "NestedLoopJoin" in final) else "no",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print("| query | shuffles | broadcasts | Python stages | cartesian | columns read |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        f = facts(df._jdf.queryExecution().executedPlan().toString())
        cols = f["columns read"].replace("|", "/")
        print(f"| {name} | {f['shuffles']} | {f['broadcasts']} | {f['python']} | {f['cartesian']} | {cols} |")


if __name__ == "__main__":
    main()
