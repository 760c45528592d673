"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query is built and fully executed into the
``noop`` sink (no driver collect); the median of the warm runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fairway.operators.joins import run_scope  # noqa: E402
from fairway.plans import catalog  # noqa: E402
from fairway.session import get_spark  # noqa: E402

HEADLINE = ("event_difficulty", "course_factor", "rolling_index_25", "rolling_index_multi",
            "score_distribution", "current_standings", "ingest_rounds", "score_share_rows",
            "weighted_index_by_course", "wave_average", "venue_extremes", "majors_ranked",
            "venue_median", "ingest_quarantine", "parquet_roundtrip", "form_index_sink")


def run_once(spark, name: str, sf_dir: str) -> float:
    with run_scope():  # cached and written tables belong to this run
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(f"local[{cpus}]", app_name="fairway-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    results, errors = {}, {}
    for name in HEADLINE:
        try:
            run_once(spark, name, sf_dir)  # warm-up (JIT, file listing)
            results[name] = round(statistics.median(run_once(spark, name, sf_dir)
                                                    for _ in range(repeat)), 3)
        except Exception as exc:  # noqa: BLE001 - report, keep the JSON line
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_median_total", "value": round(sum(results.values()), 3),
           "unit": "sec", "queries": results,
           "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
