"""Write the physical plan of every registered analytics job to PLANS.md.

Usage: python scripts/dump_plans.py [sf_dir] [out_file]

Plans are the initial AQE plans (before run-time re-optimisation), with
expression ids removed and long lines shortened.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    from tidepool.plans import catalog
    from tidepool.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    parts = ["# Physical plans of the registered queries\n",
             f"Generated by `scripts/dump_plans.py` over `{sf_dir}` (initial AQE plans; "
             "sizes below the broadcast threshold become broadcast joins here and would "
             "stay sort-merge joins, with skew splitting, on large inputs).\n"]
    for name, fn in catalog.queries().items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = []
        for line in plan.rstrip().split("\n"):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*\], ", "", line)
            lines.append(line if len(line) <= 230 else line[:227] + "...")
        parts.append(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    spark.stop()
    with open(out, "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
