"""Bench: headline queries of the catalog on local[$BENCH_CPUS] at
$BENCH_SF_DIR (default /root/testdata/sf0.1).  Each query is forced with a
``noop`` write (full computation, no collect); prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardforge.plans.catalog import QUERIES  # noqa: E402
from cardforge.session import local_session  # noqa: E402

HEADLINE = [
    "heading_subject_counts",  # flagship: DOM-1 + DOM-3 + CAT-1/3 over real pages
    "dom_nodes",               # DOM-1 node table over real pages
    "extract_lessons",         # DOM-2..7 rule extractor
    "index_links",             # DOM-9
    "extraction_requests",     # EXT-1
    "explode_items",           # JSN-1..8, EXT-3
    "number_items",            # NUM-1
    "group_by_subject",        # CAT-2
    "apply_questions",         # QST-1..6
    "follow_chain",            # TRV-1
    "until_first_repeat",      # TRV-3
    "resolve_url",             # URL-1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), "cardforge-bench")
    # warm the JVM (class loading, JIT, codegen) outside the timings: one
    # untimed pass over the smallest data set, nothing cached between passes
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and warm.rstrip("/") != sf_dir:
        for name in names:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
