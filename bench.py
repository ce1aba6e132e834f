"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.  Each query is fully executed with the ``noop``
sink (every row produced, nothing collected to the driver).  Set
$BENCH_EVENT_LOG_DIR to a scratch folder to keep Spark's event log (stage
and task times)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forumlens.plans import all_queries  # noqa: E402
from forumlens.session import build_session  # noqa: E402

HEADLINE = [
    "user_tag_score", "top_experts", "recommend_users", "qa_join",
    "training_set", "post_tag_labels", "post_tag_labels_substring",
    "clean_text", "tok_stopwords", "hashed_tf", "nb_train",
    "score_linear_models", "frequent_itemsets", "association_rules",
    "pic_edges", "power_iteration_vector", "pic_assign", "auc_roc", "auc_pr",
    "xml_posts", "json_qa_join", "train_one_tag", "predict_and_recommend", "train_all_tags",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:  # stage/task times for later inspection (no UI is started)
        os.makedirs(log_dir, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          extra=extra)
    qs = all_queries()
    times = {}
    # warm-up of the JVM and codegen on the smallest fixture (other data, same
    # code paths; nothing is cached between queries)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for n in ("questions", "user_tag_score", "hashed_tf"):
        qs[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
