"""Write PLANS.md: the final (adaptive) physical plan of the reference's queries.

Usage: python tools/show_plans.py [sf_dir] [out.md]
Each query is executed once so the adaptive plan is final (stage reuse,
broadcasts chosen from measured sizes, coalesced partitions). Expressions
are shortened to keep the operator tree readable.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.plans.queries import QUERIES  # noqa: E402
from tidepool.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Reused|QueryStage|Window|Aggregate|Join|Scan|Generate|"
                  r"Filter|Sort |Union|Expand|Subquery|Coalesce|Python|Project|Limit)")


def tidy(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([a-z]+\.parquet)\]",
                  r"Location: \1", line)
    return line if len(line) <= 220 else line[:217] + "..."


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[8]", shuffle_partitions=16)
    parts = ["# PLANS", "",
             f"Final adaptive physical plans of the registered queries on `{sf_dir}`,",
             "generated by `tools/show_plans.py` (expressions shortened).", ""]
    for name, fn in QUERIES.items():
        qe = fn(spark, sf_dir)._jdf.queryExecution()
        qe.executedPlan().executeCollect()
        text = qe.executedPlan().toString()
        final = text.split("+- == Initial Plan ==")[0]
        lines = [tidy(x) for x in final.splitlines() if KEEP.search(x)]
        parts += [f"## {name}", "", "```", *lines, "```", ""]
    spark.stop()
    with open(out, "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
