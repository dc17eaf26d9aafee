"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. BENCH_QUERIES, a comma
list of name parts or "all", picks other queries. Each query runs to the end of a sink
that discards its rows; the first run of the session is a warm-up and not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.queries import load_all  # noqa: E402
from cadenza.session import build_session  # noqa: E402

HEADLINE = [
    "r04_top_by_mood",
    "k01_collect",
    "k02_preprocess_standard",
    "k03_preprocess_large",
    "k04_profile_report",
    "a10_describe_lines",
    "a11_correlations_all_numeric",
    "a13_box_by_mood",
    "d01_keep_first",
    "w05_recent_searches",
    "v09_nearest_inner_product",
    "v10_nearest_cosine",
    "r01_similar_by_features",
    "r02_hybrid_by_id",
    "r06_similar_by_name",
    "e08_report",
    "q02_tfidf_weights",
    "q03_tfidf_search",
    "q05_fuzzy_search",
    "q07_vibe_search",
    "q08_search",
    "j05_best_of_all_pairs",
    "v11_nearest_to_vectors",
    "r03_hybrid_by_vector",
    "q10_search_service",
    "m01_profile_examples",
    "m04_contrastive_loss",
    "m05_retrieval_loss",
    "m06_embed_items",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = build_session("cadenza-bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registered = load_all()[0]
    names = HEADLINE
    if wanted == "all":
        names = list(registered)
    elif wanted:
        names = [n for n in registered if any(w in n for w in wanted.split(","))]

    def run(name):
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("r04_top_by_mood")
    run("v09_nearest_embeddings")
    times = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    if not wanted:
        # fitting a search index and asking it, apart
        from cadenza.plans import search
        from cadenza.queries.base import searches, tracks
        start = time.perf_counter()
        index = search.build_search_index(tracks(spark, sf_dir))
        times["search_fit"] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()
        search.search(index, searches(spark, sf_dir), 8).write.format("noop").mode("overwrite").save()
        times["search_ask"] = round(time.perf_counter() - start, 3)
    per_query = {}
    if "v10_nearest_cosine" in times:
        # ten nearest rows for every row of the catalog
        seeds = spark.read.parquet(f"{sf_dir}/part.parquet").count()
        per_query["knn_ms_per_query"] = round(1000 * times["v10_nearest_cosine"] / seeds, 4)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), **per_query,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
