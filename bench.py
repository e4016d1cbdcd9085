"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "decayed_counters_user",
    "decayed_counters_all",
    "user_history",
    "asof_last_event",
    "cg_rank_counts",
    "cg_rank_stats",
    "cg_yield_summary",
    "wordcount_regex",
    "wordcount_space",
    "wordcount_nonword",
    "wordcount_job_metrics",
    "label_describe",
    "dense_index",
    "stratified_split",
    "neg_downsample",
    "feature_pipeline",
    "embedding_join_dot",
    "embedding_pool",
    "roc_auc",
    "avg_precision",
    "f1_sweep",
    "bce_report",
    "counter_job",
    "history_job",
    "stream_decayed_counters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the executor threads
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}
        )
    )


if __name__ == "__main__":
    main()
