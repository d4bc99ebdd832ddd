"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs per query after one warm-up; the median counts. Results go to the ``noop`` sink, so every
row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ratewell.plans.feature_job import build_lookup_tables  # noqa: E402
from ratewell.queries import QUERIES  # noqa: E402
from ratewell.session import build_session, scratch_path  # noqa: E402
from ratewell.sources.reviews import reviews, table  # noqa: E402

HEADLINE = [
    "loo_all_keys",
    "loo_all_keys_window",
    "lookup_join_stats",
    "feature_job",
    "ridge_alpha_grid_embeddings",
    "masked_mean_pool",
    "vocabulary",
    "encode_batches",
    "blend_weight_sweep",
    "holdout_split",
    "subset_sample",
    "standardize",
    "hashed_embeddings",
]

# Published rows and seconds of the feature job on its cluster.
PUBLISHED_ROWS, PUBLISHED_SECONDS = 3_007_439, 23.3


def lookup_tables(spark, folder):
    """The published job's work: three key tables and the prior, written."""
    build_lookup_tables(reviews(spark, folder), scratch_path(spark, "bench"))


def timed(work) -> float:
    start = time.perf_counter()
    frame = work()
    if frame is not None:
        frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "ratewell-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    works = {"lookup_tables": lookup_tables, **{name: QUERIES[name] for name in HEADLINE}}
    seconds = {}
    for name, query in works.items():
        timed(lambda: query(spark, folder))
        seconds[name] = round(statistics.median(timed(lambda: query(spark, folder)) for _ in range(runs)), 3)
    rows = table(spark, folder, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "rows": rows,
                "published_job_seconds_at_these_rows": round(PUBLISHED_SECONDS * rows / PUBLISHED_ROWS, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
