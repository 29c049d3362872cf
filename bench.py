"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (all rows are
produced, nothing is collected): one warm-up run, then the median of
$BENCH_RUNS timed runs.  Shuffle and input bytes per query come from the
Spark event log written to a scratch folder.  Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "fct_events",
    "product_features_monthly",
    "product_features_monthly_a1",
    "user_features_monthly",
    "user_product_interactions_monthly",
    "sessions",
    "session_start",
    "backfill_snapshots",
    "training_set",
    "classification_metrics",
    "model_comparison",
    "score_requests",
]


def _walk_plan(info: dict):
    yield info
    for child in info.get("children", []):
        yield from _walk_plan(child)


def _event_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """Per job group: shuffle bytes written (task metrics) and bytes of the
    scanned files (the scan nodes' driver-side "size of files read" metric;
    task-level bytesRead misses parquet reads on the local file system)."""
    stage_group: dict[int, str] = {}
    exec_group: dict[int, str] = {}
    scan_ids: dict[int, set] = {}
    scan_bytes: dict[int, int] = {}
    out: dict[str, dict[str, int]] = {}
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event", "")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    group = props.get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                        if props.get("spark.sql.execution.id") is not None:
                            exec_group[int(props["spark.sql.execution.id"])] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    tm = ev.get("Task Metrics") or {}
                    if group:
                        acc = out.setdefault(group, {"shuffle_bytes": 0, "input_bytes": 0})
                        acc["shuffle_bytes"] += (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                elif kind.endswith("SparkListenerSQLExecutionStart") or kind.endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
                    ids = scan_ids.setdefault(int(ev["executionId"]), set())
                    for node in _walk_plan(ev.get("sparkPlanInfo") or {}):
                        for m in node.get("metrics", []):
                            if m.get("name") == "size of files read":
                                ids.add(int(m["accumulatorId"]))
                elif kind.endswith("SparkListenerDriverAccumUpdates"):
                    eid = int(ev["executionId"])
                    ids = scan_ids.get(eid, set())
                    for acc_id, value in ev.get("accumUpdates", []):
                        if int(acc_id) in ids:
                            scan_bytes[eid] = scan_bytes.get(eid, 0) + int(value)
    for eid, b in scan_bytes.items():
        group = exec_group.get(eid)
        if group:
            out.setdefault(group, {"shuffle_bytes": 0, "input_bytes": 0})["input_bytes"] += b
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    log_dir = tempfile.mkdtemp(prefix="demandlake-bench-events-")

    from demandlake import session as S
    spark = S.build(f"local[{cpus}]", app="demandlake-bench", shuffle_partitions=cpus * 2,
                    extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                           "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                           "spark.eventLog.compress": "false"})
    S.checkpoint_dir(spark)
    from demandlake.queries import QUERIES

    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            group = f"{name}#timed" if i == runs else f"{name}#{i}"
            spark.sparkContext.setJobGroup(group, name)
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:  # first run warms the JVM and the file cache
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    metrics = _event_metrics(log_dir)
    shuffle = {n: metrics.get(f"{n}#timed", {}).get("shuffle_bytes", 0) for n in names}
    inputs = {n: metrics.get(f"{n}#timed", {}).get("input_bytes", 0) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_bytes": shuffle,
        "input_bytes": inputs,
    }))


if __name__ == "__main__":
    main()
