"""Wall time of the headline queries: one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8), BENCH_QUERIES
an optional comma list of other registered queries.
"""

from __future__ import annotations

import json
import os
import time

from shelfscout.queries import QUERIES
from shelfscout.session import local_session

HEADLINE = [
    "enrich_reviews",
    "item_review_aggregates",
    "vote_distribution",
    "recommend_rate_top_items",
    "playtime_histogram",
    "winsorize",
    "numeric_features",
    "popularity_sample",
    "token_frequency",
    "multi_hot",
    "tfidf",
    "interaction_universe",
    "holdout_split",
    "topk_per_user",
    "heldout_rank",
    "popularity_hr",
    "user_profiles",
    "content_hr",
    "recommend_top_n",
    "hybrid_alpha_sweep",
    "cluster_profiles",
    "lloyd_descent",
    "silhouette_sampled",
    "kmeans_fit",
    "svd_text",
    "mf_loss_curve",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("shelfscout-bench", cores=cores, shuffle_partitions=cores)
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
