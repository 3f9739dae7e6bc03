"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codeloom.plans.workload import QUERIES  # noqa: E402
from codeloom.session import build_session  # noqa: E402

HEADLINE = [
    "ext1_tokenize_sources",
    "ext2_extract_functions",
    "ext16_corpus_stats",
    "lab2_deterministic_side_effects",
    "lab2_side_effects_from_table",
    "emb2_hash_embed",
    "fus3_apply_scaler",
    "fus4_fuse",
    "cls3_split",
    "cls6_classification_report",
    "ret2_top_k_neighbours",
    "ret7_retrieval_report",
    "ret9_worst_query",
    "clu4_cluster_profile",
    "rep1_histogram",
    "rep2_describe",
    "rep2_describe_features",
    "src1_read_sources",
    "lab11_enrich_incremental",
    "lab_label_functions",
    "cls7_ablation",
    "clu1_fit_kmeans",
    "sco1_score_sources",
    "sco2_score_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)))
    spark.sparkContext.setLogLevel("OFF")
    # Start the JVM code paths and the Python workers before anything is timed.
    QUERIES["clu4_cluster_profile"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
