"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gleanery.queries import QUERIES  # noqa: E402
from gleanery.session import build_session  # noqa: E402

HEADLINE = [
    "article_extract", "tokenize_regex", "tokenize_lemma", "term_freq", "doc_freq", "vocab_top",
    "tfidf_weights", "singular_values", "concept_terms", "concept_docs", "keyword_search_exact",
    "keyword_search_reduced", "genre_lookup", "zscore", "assign_distance", "lloyd_step",
    "cluster_sizes", "elbow", "outliers_top25", "cluster_sample", "kmeans_sweep",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false", "spark.gleanery.spread": "true",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["doc_freq"](spark, folder).count()
    seconds = {}
    for name in names:
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
            }
        )
    )


if __name__ == "__main__":
    main()
