"""Time every registered query over whole tables; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Names given as
arguments limit the run to those queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from intentloom.plans import load_queries
from intentloom.session import local_session

# What the baseline's context build covers, here for all users in one job.
CONTEXT = "render_prompt"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_queries()
    names = sys.argv[1:] or list(queries)
    run(queries["extract_json"](spark, sf_dir))  # starts the JVM's scan path and Python workers
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if CONTEXT in seconds:
        users = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
        out["context_users_per_sec"] = round(users / seconds[CONTEXT], 1)
        out["context_sec_per_user"] = round(seconds[CONTEXT] / users, 6)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
