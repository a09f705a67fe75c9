"""Times every registered query; prints one JSON line."""

import json
import os
import statistics
import sys
import time

from seqtable import session
from seqtable.plans import registry, second

QUERIES = registry.QUERIES | second.QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def main() -> None:
    spark = session.build(
        f"local[{CPUS}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            # A few megabytes would be merged into one partition and leave the other cores idle.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = ONLY or list(QUERIES)
    for name in names[:4]:  # warms up the JVM; the others share most of this code
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        laps = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps), 4)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "shuffle_partitions": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
