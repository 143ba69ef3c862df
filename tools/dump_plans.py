"""Write PLANS.md: the physical plan trees of the headline queries, planned with
broadcasts off (the shapes large inputs get). Usage: python tools/dump_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fernhill.plans.registry import load_all  # noqa: E402
from fernhill.session import build_session  # noqa: E402

QUERIES = ["c1_furthest_view", "c2_catalogue_latest", "c3_weekday_snapshots", "c5_basic_metrics",
           "j2_not_in", "k5_upsert", "c21_resolve_titles"]


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in text.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        lines.append(line[:160])
        if "FileScan" in line:
            pad = " " * (len(line) - len(line.lstrip(" :+-")) + 3)
            for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                m = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", line)
                if m and m.group(1) not in ("[]", "struct<>"):
                    lines.append(f"{pad}{key}: {m.group(1)[:200]}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    reg = load_all()
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `tools/dump_plans.py` on `{os.path.basename(sf)}` with "
           "`spark.sql.autoBroadcastJoinThreshold=-1`, so joins show the shape large inputs get. "
           "`AdaptiveSparkPlan isFinalPlan=false` is the plan before AQE's runtime changes "
           "(coalescing, skew splits). The derived inputs of each query (see README) are part of its plan.",
           ""]
    for name in QUERIES:
        df = reg[name].build(spark, sf)
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
