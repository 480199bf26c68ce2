"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores, BENCH_QUERIES a subset
(comma-separated name prefixes). Every result is written whole to the no-op sink. A query
runs once over the smallest tables beforehand; its figure is the median of BENCH_RUNS runs.
``duckdb`` holds the seconds of its SQL on the same files, where there is one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketmill.catalog import ORACLES, QUERIES  # noqa: E402
from ticketmill.catalog.check import connect  # noqa: E402
from ticketmill.session import build_session  # noqa: E402

HEADLINE = (
    "tx2_strip_html_decode_entities", "tx9_clean_text_by_channel", "job1_clean_tickets", "job2_clean_and_redact",
    "pii9_redact", "pii10_redaction_audit", "pii14_hits_by_type", "pii12_leftovers", "agg2_qa_report",
    "src1_read_landing", "src2_attach_comments", "snk2_upsert_snapshot_table", "str1_stream_upsert",
    "win2_latest_version", "jn1_unprocessed", "agg10_describe", "agg11_text_length_quantiles",
    "ml4_distance_to_centroid", "ml5_silhouette_points", "jn5_noise_to_nearest_centroid", "jn9_top_k_similar",
    "win1_cluster_examples", "lb2_class_terms", "emb1_embed_documents", "ml1_reduce", "ml3_density_cluster",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARM_UP = "/root/testdata/sf0.001"


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = tuple(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    sql_seconds: dict[str, float] = {}
    con = connect(sf)
    con.execute(f"SET threads = {int(cpus)}")
    for name in HEADLINE:
        if wanted and not name.startswith(wanted):
            continue
        if os.path.isdir(WARM_UP):
            QUERIES[name](spark, WARM_UP).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        if name in ORACLES:
            start = time.perf_counter()
            con.execute(ORACLES[name]).fetchall()
            sql_seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], sql_seconds.get(name), file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "duckdb": sql_seconds, "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
