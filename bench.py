"""Time the headline jobs and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the best of the runs is reported per query).
Every headline query first runs once on sf0.001 to warm the JVM (class
loading, code generation, JIT); no result is reused across data folders.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
BENCH_EVENT_LOG=<folder> (optional) writes Spark's event log there, for stage and
task times without the web UI.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlab.plans import catalog  # noqa: E402
from cohortlab.session import build_session  # noqa: E402

HEADLINE = [
    "sepsis_date",            # K1 cohort dating (flagship)
    "sepsis_date_branches",   # K1, literal three-branch form
    "last_record_date",       # K2
    "vitals_filter",          # K3
    "patient_details",        # K4
    "vitals_features",        # K5 80-column feature table
    "notes_concat",           # K6
    "note_terms",             # K7 bag of words
    "vocabulary",             # K7 vocabulary (top 10,000 terms)
    "topic_columns",          # K7 online LDA topic features
    "topk_per_group",         # top-100 terms per language over all documents
    "dm_phenotype",           # K8
    "roc_curve",              # K9 metrics
    "confusion_matrix",
    "auc_score",
    "logistic_scores",        # K9 model loop: two fits over features and topics
    "model_comparison",
]
#: Jobs of many passes are timed once.
ONCE = {"logistic_scores", "model_comparison"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="cohortlab-bench",
                          extra=extra)
    catalog.load_all()

    # warm-up: JVM, codegen caches and the Python worker on the smallest tables
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for q in HEADLINE:
            catalog.QUERIES[q](spark, warm).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(1 if name in ONCE else repeat):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
