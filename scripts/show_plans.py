"""Print the physical plan outline of the headline jobs as Markdown (for PLANS.md).

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
Only the operator tree of ``explain("formatted")`` is kept (node details dropped);
the counts line gives the shuffles, broadcasts and joins of each job.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from cohortlab.plans import catalog  # noqa: E402
from cohortlab.session import build_session  # noqa: E402

SKIP = {"topic_columns", "logistic_scores", "model_comparison"}  # fit models when called; their plans scan kept tables


def outline(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    return "\n".join(line for line in tree.splitlines() if line.strip() and not line.startswith("=="))


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    catalog.load_all()
    print("# Physical plans of the headline jobs\n")
    print(f"Generated by `scripts/show_plans.py {sf_dir}` (plans before AQE re-planning; AQE may still turn a "
          "shuffle join into a broadcast join and coalesce partitions at run time).\n")
    for name in HEADLINE:
        if name in SKIP:
            continue
        tree = outline(catalog.QUERIES[name](spark, sf_dir))
        shuffles = len(re.findall(r"Exchange \(\d+\)", tree)) - len(re.findall(r"BroadcastExchange \(\d+\)", tree))
        counts = (f"shuffle exchanges: {shuffles}, broadcasts: {len(re.findall(r'BroadcastExchange', tree))}, "
                  f"sort-merge joins: {len(re.findall(r'SortMergeJoin', tree))}, "
                  f"broadcast joins: {len(re.findall(r'BroadcastHashJoin', tree))}, "
                  f"Python UDFs: {len(re.findall(r'BatchEvalPython|ArrowEvalPython', tree))}")
        print(f"## `{name}`\n\n{counts}\n\n```\n{tree}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
