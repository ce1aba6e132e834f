"""Scaling experiment only: write k copies of a given scale's tables into a
new folder, shifting the keys of each copy so joins stay one-to-one.  The
correctness checks never use this data."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from forumlens.session import build_session  # noqa: E402
from forumlens.sources.fixtures import TABLES  # noqa: E402

# table -> key columns shifted per copy (dimension tables are kept once)
KEYS = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"],
        "documents": ["doc_id"], "labels": ["doc_id"], "pages": ["page_id"],
        "events": ["event_id"], "embeddings": ["vec_id"],
        "conversations": ["conv_id"]}


def main() -> None:
    src, dst, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = build_session()
    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in KEYS:
            span = {c: df.agg(F.max(c)).first()[0] + 1 for c in KEYS[t]}
            if t == "labels":
                span = {"doc_id": spark.read.parquet(f"{src}/documents.parquet")
                        .agg(F.max("doc_id")).first()[0] + 1}
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            for c, n in span.items():
                df = df.withColumn(c, (F.col(c) + F.col("_copy") * n).cast(df.schema[c].dataType))
            df = df.drop("_copy")
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())


if __name__ == "__main__":
    main()
