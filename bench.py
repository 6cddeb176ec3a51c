"""Time the headline queries: one warm-up, then the median of the timed runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame

from ticktalk.catalog import QUERIES
from ticktalk.session import local_session

HEADLINE = (
    "mention_leaderboard", "mention_counts", "json_required_keys", "spam_filter", "bot_tag_filter", "normalise_messages",
    "time_parts", "ts_reformat", "parse_vectors", "asof_nearest", "asof_backward_by_user", "left_join_dropna",
    "nearest_centroid", "channel_enrich", "daily_stats", "describe_value", "describe_change", "null_profile",
    "distinct_profile", "histogram_change", "histogram_length", "binned_change", "hourly_counts", "gap_change",
    "rolling_prev4", "forward_fill", "drop_consecutive", "latest_n_per_channel", "latest_per_key", "longest_texts",
    "newest_rows", "keyed_sample", "union_drift_dedup", "csv_roundtrip", "keyed_upsert", "kmeans_labels", "pca_map",
    "hash_embedding", "stream_windows", "stream_messages", "stream_score", "stream_dedup",
)
# Dominated by opening one file per hour on a local disk; timed once.
ONCE = ("hourly_message_batch", "stream_fanout")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session("bench", cpus)
    times: dict[str, float] = {}
    for name in (*HEADLINE, *ONCE):
        taken = []
        for _ in range(1 if name in ONCE else repeats + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(sf)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
