"""Wall time of every registered query; prints one JSON line.

Each query is planned and run ``BENCH_RUNS`` times (3 by default) with its whole result
produced and discarded; the best run counts, so that the JVM's compilation of new code,
which a long job does not notice, weighs less.  ``first`` holds the time of the first run.
"""

from __future__ import annotations

import json
import os
import time

from bandlex.session import session
from checks import queries as registered


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    spark = session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered.SPREAD = spark.sparkContext.defaultParallelism
    first, best = {}, {}
    for name, query in registered.queries().items():
        if wanted and name not in wanted:
            continue
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        first[name], best[name] = round(times[0], 3), round(min(times), 3)
    spark.stop()
    result = {
        "metric": "total wall time of all queries",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
