"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up pass over all queries (it
also lands the derived input files a job reads, e.g. the catalogue feed and
partner reports), then ``$BENCH_RUNS`` timed passes (default 3), each query
executed to completion with the ``noop`` sink; the median per query is
reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fernhill.plans.registry import load_all  # noqa: E402
from fernhill.session import build_session  # noqa: E402

HEADLINE = [
    "c1_furthest_view",
    "c2_catalogue_latest",
    "c3_weekday_snapshots",
    "c5_basic_metrics",
    "c9_finance",
    "c16_catalogue_shows",
    "c20_titles_to_match",
    "c21_resolve_titles",
    "c22_record_matches",
    "j2_not_in",
    "k5_upsert",
    "w1_latest_per_key",
    "s5_workbook",
]


def _reference_c1(spark, sf_dir):
    """C1 as the reference plans it: max per 3 keys, join back on 4 keys, min per 4 keys."""
    from fernhill.operators.views import cdn_furthest_view
    from fernhill.plans.derive import access_log_rows
    from fernhill.plans.registry import table

    return cdn_furthest_view(access_log_rows(table(spark, sf_dir, "events")), "events",
                             method="self_join", run_ts=False)


def _reference_not_in(spark, sf_dir):
    """J2 as plain SQL NOT IN (Spark's null-aware anti join: broadcasts the subquery side)."""
    from fernhill.plans.registry import table

    p = table(spark, sf_dir, "part")
    return spark.sql("SELECT p_partkey, p_name FROM {p} WHERE p_name NOT IN "
                     "(SELECT p_name FROM {p} WHERE p_size > 45)", p=p)


REFERENCE_PLANS = {"c1_furthest_view": _reference_c1, "j2_not_in": _reference_not_in}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          app_name="fernhill-bench", **{"spark.driver.memory": "16g"})
    reg = load_all()
    names = list(only or HEADLINE)
    errors: dict[str, str] = {}
    for name in list(names):   # warm-up pass over all queries: JIT, codegen cache, landed inputs
        try:
            reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report, keep timing the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            names.remove(name)
    samples: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):
        for name in names:
            t0 = time.perf_counter()
            reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples[name].append(time.perf_counter() - t0)
    times = {n: round(statistics.median(v), 3) for n, v in samples.items()}
    # the reference's plan shapes for the same results, for comparison (not in the total)
    reference: dict[str, float] = {}
    if not only:
        for name, build in REFERENCE_PLANS.items():
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            ref = []
            for _ in range(runs):
                t0 = time.perf_counter()
                build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                ref.append(time.perf_counter() - t0)
            reference[name] = round(statistics.median(ref), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "runs": runs, "reference_plan_sec": reference,
                      **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
