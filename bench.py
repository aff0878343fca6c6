"""Headline timings: one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose the data and the slots."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from webwinnow.plans.catalog import QUERIES  # noqa: E402
from webwinnow.plans.session import configure  # noqa: E402

HEADLINE = (
    "extract_full", "extract_cached", "markdown", "validation", "scored_blocks", "noise_blocks", "static_prune",
    "dynamic_prune", "mapped_container", "heal_ladder", "embedded_frames", "node_counts", "article_text",
    "page_titles", "with_quality_documents", "doc_boilerplate", "doc_noise_gate", "boundary_gate", "search_topk",
    "search_digest", "requested_urls", "result_envelopes", "structure_upsert", "category_report", "overall_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("webwinnow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.webwinnow.readSplits", cpus)  # the tables have one row group each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per expression
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    names = sys.argv[1:] or HEADLINE
    QUERIES["page_titles"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start Python workers
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    line = {
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"), "pages": pages,
    }
    if "extract_full" in seconds:
        line["pages_per_second"] = round(pages / seconds["extract_full"], 1)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
