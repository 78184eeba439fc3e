"""Time the headline queries; prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "read_dumps",
    "dedup_by_id",
    "url_record_arrays",
    "url_batches",
    "url_checks",
    "extract_article",
    "extract_paragraphs",
    "clean_html",
    "document_round_trip",
    "min_total_score",
    "minhash",
    "greedy_dedup",
    "incremental_dedup",
    "file_batches",
    "corpus_stats",
    "clean_corpus",
    "corpus_from_dumps",
    "stream_ingest",
]


def warm_up(spark, sf_dir: str) -> None:
    """Start the JVM's code paths and the Python workers once; that is no part of any query."""
    from pyspark.sql import functions as F

    from linkmill.session import scratch_path
    from linkmill.sources.documents import write_documents

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.groupBy("event_type").count().collect()
    write_documents(events.limit(1).select(F.lit("x").alias("text"), F.lit("{}").alias("meta")), scratch_path(spark, "warm-up"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    from linkmill.plans.queries import QUERIES
    from linkmill.session import local_session

    spark = local_session(cores)
    warm_up(spark, sf_dir)
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": float(sf)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
