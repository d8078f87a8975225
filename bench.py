"""Time the headline queries and print one JSON line.

Each query is built and run to the end (every row computed, none kept) once to
warm up and ``BENCH_RUNS`` times for the record; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tokenloom.plans.queries import QUERIES
from tokenloom.session import local_session

HEADLINE = [
    "word_count", "top50_words", "cooc_pairs_d1", "cooc_pairs_d2", "cooc_pairs_d3", "cooc_pairs_d4",
    "cooc_pairs_sweep", "cooc_pairs_refold", "cooc_stripes_text_d2", "cooc_stripes_sweep",
    "cooc_pairs_long_list_d2", "stem_vocab", "doc_freq", "top100_df", "term_freq", "tf_score",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores)
    times = {}
    for name in HEADLINE:
        run(spark, sf_dir, name)
        times[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds, headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
