"""Benchmark the headline jobs and print one JSON line.

    BENCH_SF_DIR  fixture folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_REPEAT  timed runs per job, median reported (default 3)

Each job runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  Jobs follow the baseline
table: marts + join, leakage audit, split + encode, AUC/AP/KS, score + deciles
+ PSI, and tree attribution of 5,000 rows (model fit timed apart).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(build, spark) -> float:
    times = []
    for _ in range(REPEAT):
        t0 = time.perf_counter()
        _run(build(spark, SF_DIR))
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


EVENT_LOG_DIR = os.environ.get("BENCH_EVENT_LOG_DIR")  # optional: shuffle bytes per job


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, read back from Spark's event log."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    files = sorted(os.path.join(root, f) for root, _, fs in os.walk(log_dir) for f in fs
                   if f.startswith(("events_", "local-", "app-")))
    for path in files:
        if path.endswith(".zstd"):
            import io as _io

            import zstandard
            fh = _io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")))
        else:
            fh = open(path)
        with fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten" and group:
                            written[group] = written.get(group, 0) + int(acc.get("Value", 0))
    return written


def main() -> None:
    from riskspark.session import local_session
    from riskspark.plans import queries as Q
    from riskspark.plans import modeling, model_queries as MQ

    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": EVENT_LOG_DIR} if EVENT_LOG_DIR else None
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app_name="riskspark-bench", extra=extra)
    jobs = {
        "marts_join": Q.q_features,
        "leakage_audit": Q.q_leakage_audit,
        "split_encode": Q.q_encoded_features,
        "auc_ap_ks": Q.q_ranking_metrics,
        "score_deciles": Q.q_score_deciles,
        "psi": Q.q_psi_summary,
        "missingness": Q.q_missingness,
    }
    sc = spark.sparkContext
    for _ in range(2):  # JVM (JIT) and file-cache warm-up
        _run(Q.q_features(spark, SF_DIR))
    out: dict[str, float] = {}
    for name, build in jobs.items():
        sc.setJobGroup(name, name)
        out[name] = round(_time(build, spark), 3)

    sc.setJobGroup("model_fit", "model_fit")
    t0 = time.perf_counter()
    modeling.cached_run(spark, SF_DIR, modeling.QUERY_BUDGET)
    out["model_fit"] = round(time.perf_counter() - t0, 3)
    sc.setJobGroup("tree_shap", "tree_shap")
    out["tree_shap"] = round(_time(MQ.q_shap_values, spark), 3)

    m = re.search(r"sf([0-9.]+)", SF_DIR)
    sf = float(m.group(1)) if m else None
    total = round(sum(out.values()), 3)
    result = {"metric": "total_job_seconds", "value": total, "unit": "sec",
              "queries": out, "sf": sf, "cpus": int(CPUS), "repeat": REPEAT}
    if EVENT_LOG_DIR:
        spark.stop()
        result["shuffle_bytes"] = _shuffle_bytes(EVENT_LOG_DIR)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
