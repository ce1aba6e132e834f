"""Write the physical plans of selected queries to PLANS.md.

Plans are taken with automatic broadcast disabled, i.e. the shapes a large
input would get before AQE's runtime re-planning (which may still turn a
join whose side proves small into a broadcast, or split a skewed partition).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forumlens.plans import all_queries  # noqa: E402
from forumlens.session import build_session  # noqa: E402

QUERIES = ["user_tag_score", "top_experts", "recommend_users", "post_tag_labels",
           "post_tag_labels_substring", "score_linear_models",
           "hashed_tf", "nb_train", "power_iteration_vector", "auc_roc"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    qs = all_queries()
    out = ["# Physical plans", "",
           "Generated by `tools/explain_plans.py` (automatic broadcast disabled, "
           "AQE on: initial plans before runtime re-planning).", ""]
    for n in QUERIES:
        df = qs[n](spark, sf)
        plan = spark._jvm.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "simple")
        out += [f"## {n}", "", "```", plan.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
