"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with seconds and input rows a second of each.

Every query runs twice and the second run counts, so none pays for the JVM's warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from flowgraph.session import build_session  # noqa: E402

HEADLINE = [
    "p9_features",
    "a1_super_edges",
    "w3_split_mask",
    "a2_edge_features",
    "d1_not_null",
    "j4_knn",
    "j5_search_cves",
    "j7_hybrid_inference",
    "a7_threshold_sweep",
    "a10_roc_auc",
    "x14_analysis_record",
    "m1_attention_layer",
    "m7_embed_texts",
    "s20_crawl_frontier",
    "s14_upsert",
]

#: The largest table that a query reads, where that is not ``lineitem``.
MAIN_TABLE = {
    "j4_knn": "embeddings",
    "j5_search_cves": "documents",
    "j7_hybrid_inference": "events",
    "a7_threshold_sweep": "events",
    "a10_roc_auc": "events",
    "x14_analysis_record": "events",
    "m1_attention_layer": "events",
    "m7_embed_texts": "documents",
    "s20_crawl_frontier": "pages",
    "s14_upsert": "documents",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, per_second, rows = {}, {}, {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        table = MAIN_TABLE.get(name, "lineitem")
        if table not in rows:
            rows[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        per_second[name] = round(rows[table] / seconds[name])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows_per_second": per_second,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
