"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs per query (the median counts). The raw tables
and the mart are written once, timed as ``write_raw_tables`` and ``build_mart``.
Reports read the mart's tables, as they do in use; staging, collection and
profiling queries start from the raw tables each time, and ``q_fact_sales`` joins
and numbers the fact again.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from clickloom.session import local_session
from clickloom.workspace import release
from harness.catalog import QUERIES, Domain


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}

    # the session's first job pays for starting the JVM's code generation
    spark.range(1000).selectExpr("sum(id)").collect()
    domain = Domain.of(spark, sf_dir)
    seconds["write_raw_tables"] = timed(
        lambda: (domain.stored_events, domain.products, domain.ip_locations)
    )
    seconds["build_mart"] = timed(lambda: domain.mart.tables())
    for name, query in QUERIES.items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue

        def run(query=query):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        seconds[name] = statistics.median(timed(run) for _ in range(runs))
        print(f"{name} {seconds[name]:.2f}", file=sys.stderr, flush=True)

    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    release(spark)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
