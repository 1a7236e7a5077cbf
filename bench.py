"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from textprep.plans.queries import REGISTRY
from textprep.session import build_session

HEADLINE = (
    "label_share_clean",
    "clean_documents",
    "clean_pages_text",
    "dedup_keep_first",
    "drop_conflicts",
    "stratified_split",
    "prep_report",
    "leakage_audit",
    "drop_train_overlap",
    "binary_metrics",
    "classification_report",
    "roc_auc",
    "best_f1_threshold",
    "rank_models",
    "term_stats",
    "tfidf_vocab",
    "tfidf_vectors",
    "word_vocab",
    "encode_sequences_head_tail",
    "score_batches",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python workers' code paths before timing.
    warm = REGISTRY["clean_documents"](spark, sf_dir.replace(os.path.basename(sf_dir), "sf0.001"))
    warm.write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
