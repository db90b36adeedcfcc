"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (timed runs per query, default 3; the median is reported).
Each run fully materialises the result with the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkstats.plans.queries import QUERIES  # noqa: E402
from linkstats.session import build_session  # noqa: E402

HEADLINE = [
    "pair_link_counts", "pair_counts", "total_sf_counts", "spot_single", "spot_multi",
    "resolve_redirects", "resolve_redirects_cyclic", "context_vectors", "rewrite_text",
    "tokenize_offsets",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="linkstats-bench-")
    spark = build_session(f"local[{cpus}]", app="linkstats-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.local.dir": os.path.join(scratch, "local")})
    # The checkpoint folder comes from the environment's spark.checkpoint.dir; only an
    # unset one is filled in with a scratch folder.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
