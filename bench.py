"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to the ``noop`` sink (full execution, no output cost):
one warm-up, then ``BENCH_RUNS`` timed runs; the median is reported.  The
pairs ``dim_car_detail``/``dim_car_detail_semi``, ``merge_replace``/
``merge_replace_outer`` and ``extract_changed``/``extract_changed_coalesce``
measure the value of a rewrite against the source form.  ``BENCH_EVENT_LOG=1``
writes Spark's event log (stage and task times) to a new scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from torque.catalog import QUERIES, WINDOW  # noqa: E402
from torque.fixtures import MERGE_KEY, merge_incoming, merge_target, source  # noqa: E402
from torque.functions.windows import changed_in_coalesce  # noqa: E402
from torque.operators import merge as M  # noqa: E402
from torque.session import get_session, shuffle_partitions_for  # noqa: E402


def _extract_changed_coalesce(spark, sf):
    return source(spark, sf).car_sales.filter(changed_in_coalesce(WINDOW))


def _merge_replace_outer(spark, sf):
    src = source(spark, sf)
    return M.merge(merge_target(src), merge_incoming(src), [MERGE_KEY], strategy="outer")


HEADLINE = {
    "etl_car_sales": QUERIES["etl_car_sales"],
    "fact_sales": QUERIES["fact_sales"],
    "dim_car_detail": QUERIES["dim_car_detail"],
    "dim_car_detail_semi": QUERIES["dim_car_detail_semi"],
    "merge_replace": QUERIES["merge_replace"],
    "merge_replace_outer": _merge_replace_outer,
    "merge_cumulative": QUERIES["merge_cumulative"],
    "dedupe_last_write": QUERIES["dedupe_last_write"],
    "extract_changed": QUERIES["extract_changed"],
    "extract_changed_coalesce": _extract_changed_coalesce,
    "reconcile_etl_elt": QUERIES["reconcile_etl_elt"],
    "validate_report": QUERIES["validate_report"],
}


def input_bytes(sf_dir: str) -> int:
    return sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir) if f.endswith(".parquet"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    parts = shuffle_partitions_for(input_bytes(sf_dir), cpus)
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    event_log = None
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times, for offline reading (the UI stays off)
        event_log = tempfile.mkdtemp(prefix="torque-events-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = get_session(f"local[{cpus}]", parts, app="torque-bench", extra=extra)
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": parts,
        "runs": runs,
        **({"event_log": event_log} if event_log else {}),
    }))


if __name__ == "__main__":
    main()
