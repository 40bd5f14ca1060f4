"""Seconds per headline query on the tables in $BENCH_SF_DIR, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from hybridflow.plans import all_queries
from hybridflow.session import build_session, prepare

HEADLINE = [
    "map_to_pair_parity",
    "reduce_by_key_total",
    "reduce_rolling",
    "reduce_rolling_by_user",
    "reduce_per_batch",
    "hybrid_join_enrich",
    "hybrid_join_enrich_orders",
    "hybrid_join_full",
    "hybrid_join_snapshot",
    "hybrid_join_repeated_side",
    "hybrid_join_enrich_stream",
    "wordcount_total",
    "wordcount_sliding",
    "wordcount_trailing",
    "lr_predict",
    "lr_gradient",
    "lr_sgd_steps",
    "lr_hybrid_retrain",
    "daily_window_union",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    prepare(spark)
    queries = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    # One unmeasured run starts the Python workers and compiles what all queries share.
    run("lr_gradient")
    run("hybrid_join_snapshot")
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
