"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each
query runs once to warm up and once timed, to a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from folioweave.queries import catalog
from folioweave.session import local_session

HEADLINE = [
    "crawl_frontier", "s2_links", "s3_resolve", "s5_urls", "h1_tokens", "h10_records", "h17_profile",
    "a1_dedup", "j2_outer_chain", "u2_rules", "u3_move_documents", "edge_curation",
    "evo_g8", "moves_g8", "dex_g8", "learnsets_g2",
]


def timed(fn, spark, sf: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    took = {}
    for name in names:
        fn = catalog.QUERIES[name]
        timed(fn, spark, sf)
        took[name] = round(timed(fn, spark, sf), 3)
    scale = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
