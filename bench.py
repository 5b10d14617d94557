"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "load_table", "fixed_width_rows", "column_profile",
    "dq_scan", "dq_duplicate_rows", "dq_missing", "dq_outliers", "dq_category_variants",
    "plan_propose", "plan_errors",
    "fix_convert_numeric", "fix_parse_dates", "fix_nullify_outlier", "fix_fill_median", "fix_drop_duplicates",
    "fix_apply_plan", "cleaning_report",
    "postings_clean", "postings_dedup", "flag_rates_by_label", "load_relational", "fk_violations", "stream_dedupe",
    "stratified_split", "classification_report", "lr_fit", "tfidf_weights", "linear_text_classifier",
    "section_carry_forward", "grid_records", "chunk_build", "encode_batch",
    "detect_entity", "knn_topk", "knn_topk_filtered", "knn_approx", "direct_answer", "answer_questions", "retrieval_accuracy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")

    from tallyrow import catalog
    from tallyrow.session import local_session

    queries = catalog.queries()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
