"""Times the jobs end to end on log lines multiplied from the shared tables.

Usage: bench_scale.py <work dir> [factor]. One line in three is the same URL. Prints JSON.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

from pyspark.sql import functions as F

from threatsieve.functions.url import lexical_features
from threatsieve.jobs.daily_report import run_report
from threatsieve.operators.scoring import score_lines
from threatsieve.plans import fixtures as fx
from threatsieve.plans.queries import models_for
from threatsieve.session import build_session
from threatsieve.sources.lines import read_lines, stream_lines
from threatsieve.streaming.scorer import Scorer, build_query, read_metrics


def main() -> None:
    work, factor = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 100
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "threatsieve-scale",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": "32", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 2)
        return result

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    copy = F.explode(F.sequence(F.lit(1), F.lit(factor))).alias("copy")
    many = fx.hits(spark, sf_dir).select("event_id", "url", copy)
    own = F.regexp_replace("url", "/app_", F.concat(F.lit("/v"), F.col("copy"), F.lit("/app_")))
    hot = (F.col("event_id") + F.col("copy")) % 3 == 0
    url = F.when(hot, F.lit("http://10.0.0.1/hot/a.sisx")).otherwise(own)
    urls = many.select(url.alias("url"))
    lines = urls.select(F.concat(F.lit("0|LTE|"), "url", F.lit("|200")).alias("value"))
    timed("write_lines", lambda: lines.repartition(64).write.text(f"{work}/lines"))
    results = urls.select(F.concat("url", F.lit("|0.58|0.9")).alias("value"))
    timed("write_results", lambda: results.repartition(64).write.text(f"{work}/results"))
    rows = read_lines(spark, f"{work}/lines").count()
    models = timed("fit_models", lambda: models_for(spark, sf_dir))

    raw = read_lines(spark, f"{work}/results").select(
        F.substring_index("value", "|", 1).alias("url")
    )
    timed("lexical_every_row", lambda: noop(lexical_features(raw)))
    batch = score_lines(read_lines(spark, f"{work}/lines"), fx.URL_INDEX, models)
    timed("score_batch", lambda: noop(batch))

    def stream() -> None:
        scorer = Scorer(models, fx.URL_INDEX, f"{work}/out", f"{work}/metrics")
        source = stream_lines(spark, f"{work}/lines", 16)
        build_query(source, scorer, f"{work}/checkpoint", None).awaitTermination()

    timed("score_stream", stream)
    for name in ("white", "black"):
        with open(f"{work}/{name}.txt", "w", encoding="utf-8") as file:
            file.write("http://10.0.0.1/hot/a.sisx\n")

    def report() -> dict[str, int]:
        now = datetime(2024, 2, 1)
        return run_report(
            spark, f"{work}/results", f"{work}/report", f"{work}/white.txt", f"{work}/black.txt",
            1000, now,
        )[1]

    counts = timed("daily_report", report)
    streamed = read_metrics(spark, f"{work}/metrics").agg(F.sum("input_count")).first()[0]
    spark.stop()
    timings = ("lexical_every_row", "score_batch", "score_stream", "daily_report")
    rates = {name: round(rows / seconds[name]) for name in timings}
    print(json.dumps(
        {"rows": rows, "streamed": streamed, "report": counts, "seconds": seconds, "rows_per_second": rates}
    ))


if __name__ == "__main__":
    main()
