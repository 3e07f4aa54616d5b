"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line; each figure is the median of $BENCH_RUNS warm runs, or
the only warm run where that takes long; ``runs`` has the number per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from signalbook.queries import QUERIES
from signalbook.session import local_session


LONG_SECS = 3.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings, counts = {}, {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
            if len(taken) == 2 and taken[1] > LONG_SECS:
                break
        counts[name] = len(taken) - 1
        timings[name] = round(statistics.median(taken[1:]), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()
    out = {
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": counts,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
