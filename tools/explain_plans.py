"""Print the formatted physical plan of registered queries and count their shuffles.

usage: python tools/explain_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkstats.plans.queries import QUERIES  # noqa: E402
from linkstats.session import build_session  # noqa: E402

HEADLINE = ["pair_link_counts", "pair_counts", "total_sf_counts", "spot_single", "spot_multi",
            "resolve_redirects", "context_vectors", "rewrite_text", "tokenize_offsets"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="linkstats-explain-")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))
        broadcasts = plan.count("BroadcastExchange")
        print(f"===== {name}: {shuffles} shuffle exchange(s), {broadcasts} broadcast(s)")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
