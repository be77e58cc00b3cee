"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
input and the local slots. BENCH_QUERIES names queries, separated by commas, or
``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableworks.plans.queries import REGISTRY  # noqa: E402
from tableworks.session import build_session  # noqa: E402

HEADLINE = [
    "access_log_weekday", "top_paths", "cluster_profile", "balance_over", "correlation_matrix",
    "metrics_auc", "gini_normalized", "bag_of_words", "vocabulary", "lm_bigram", "lm_bigram_add1",
    "cloze_bigram", "next_word", "sentence_logprob", "perceptron_weights", "tagger_weights",
    "tagger_greedy", "tag_f1", "tagger_viterbi", "tree_classifier",
    "claims_features", "claims_linear", "claims_forest", "als_clusters", "pca_explained", "logistic",
    "word_vectors", "perceptron_mixing", "grid_search",
]
# Minutes each at sf0.1, so only run when asked for (BENCH_QUERIES=all or by name): als_cv,
# als_fold_profiles, claims_gamma, grid_models, tree_threshold, tagger_transition_weights,
# next_word_net.


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM and the file cache so the first query is not charged for them.
    REGISTRY["top_paths"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
