"""Time every registered query; prints one JSON line.

All queries are run once to warm up the JVM; then each is timed, best of ``BENCH_RUNS``, into a
sink that discards the rows, so that all of them are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odskein.session import build_session  # noqa: E402
from odskein.shipping.registry import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
ONLY = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def timed(spark, run) -> float:
    start = time.perf_counter()
    run(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "odskein-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = ONLY or sorted(QUERIES)
    for name in names:
        timed(spark, QUERIES[name])
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(spark, QUERIES[name]) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all queries, best run each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
