"""Run every registered query against its DuckDB oracle and report matches.

Usage: python scripts/check_oracles.py [sf_dir] [key ...]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlab.plans import catalog  # noqa: E402
from cohortlab.plans.verify import compare, duck  # noqa: E402
from cohortlab.session import build_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    catalog.load_all()
    keys = argv[2:] or sorted(catalog.QUERIES)
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(json.dumps(r), flush=True)
    print(f"# {len(keys) - bad}/{len(keys)} ok", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
