"""Benchmark: the reference's pipeline end to end on Spark.

Stages run like the medallion job they replace: bronze (mapping over the
driver tables) -> silver tables written as Parquet -> gold tables built from
the written silver layer -> detail tables, explorations, graph queries and
recommenders from the written gold layer. Every timed step executes its
whole plan (a write, or the ``noop`` sink for report tables). Prints one
JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
SKIP_ML = os.environ.get("BENCH_SKIP_ML", "0") == "1"
#: Trees of the ranker; the job's own default is 200, whose time is mostly one job a tree level.
TREES = int(os.environ.get("BENCH_TREES", "50"))


def main() -> None:
    from mercato.session import get_session
    spark = get_session(f"local[{CPUS}]", app="mercato-bench", shuffle_partitions=max(8, CPUS * 2))
    from mercato import jobs
    from mercato.sources.fixtures import bronze_layer

    # a fresh scratch folder per run (on a cluster: BENCH_OUT_DIR on shared storage)
    base = os.environ.get("BENCH_OUT_DIR")
    out = f"{base.rstrip('/')}/run-{int(time.time())}" if base else tempfile.mkdtemp(prefix="mercato-bench-", dir="/tmp")
    times: dict[str, float] = {}
    jobs.run(spark, bronze_layer(spark, SF_DIR), out, timer=lambda n, s: times.__setitem__(n, round(s, 3)),
             ml=not SKIP_ML, trees=TREES)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "end_to_end_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": CPUS}))


if __name__ == "__main__":
    main()
