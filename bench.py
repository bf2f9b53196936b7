"""Times the headline queries and prints one JSON line.

Each time covers building and fully computing one query on its whole tables.
``prepare`` is the shared cleaned and tokenised corpus, computed once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from corpusloom.queries import QUERIES, base
from corpusloom.session import local_session

HEADLINE = [
    "clean_text", "tokenize_custom", "noise_audit", "stem_porter", "stem_snowball", "lemmatize_dictionary",
    "bow", "tfidf_smooth", "top_tfidf_terms", "discriminative_terms", "retrieve_topk", "similar_pairs",
    "corpus_centrality", "nb_predict", "nb_alpha_sweep", "eval_class_report", "eval_auc", "explain_contributions",
    "ngram_counts", "kn_perplexity", "lm_classify", "lr_eval", "split_stratified", "sliding_window_count",
    "rate_limit_admission", "tumbling_metrics", "promotion_fold", "roc_full_scores", "endpoint_summary",
]


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus, shuffle_partitions=cpus)
    times: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        start = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    def compute(name: str) -> None:
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()

    spark.range(1).count()
    timed("prepare", lambda: (base.labelled(spark, data), base.documents(spark, data)))
    for name in HEADLINE:
        timed(name, lambda: compute(name))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": data.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
