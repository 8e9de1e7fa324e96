"""Times the fit and every query of the log scorer; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from threatsieve.plans.queries import QUERIES, models_for
from threatsieve.session import build_session


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "threatsieve-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = QUERIES

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("hit_lines")  # starts the session's workers and code generation
    seconds = {"fit_models": timed(lambda: models_for(spark, sf_dir))}
    for name in QUERIES:
        seconds[name] = timed(lambda: run(name))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
