"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores.
Each query runs once to warm the JVM up and is timed on its second run, from
building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from checks import views  # noqa: E402
from checks.registry import ENTRIES  # noqa: E402
from vocatio.operators import clean  # noqa: E402
from vocatio.sources.folders import fresh_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "clean_posts",
    "clean_stats",
    "duty_sections",
    "prompt_text",
    "numbered_format",
    "standardize_rule_based",
    "standardize_with_model",
    "embed_texts",
    "cosine_topk",
    "match_top1",
    "match_rerank",
    "crosswalk_join",
    "join_failure_rate",
    "count_by_year_level1",
    "onet_prefix_trend",
    "match_quality",
    "partitioned_roundtrip",
    "csv_roundtrip",
    "incremental_clean",
    "classify_end_to_end",
]


COPIES = 60


def throughput(spark: SparkSession) -> dict[str, int]:
    """Rows per second of the cheap stages, on enough rows to outweigh start-up.

    Every document occurs ``COPIES`` times. A third of all rows share one id,
    the others have an id per copy.
    """
    copies = (
        views.documents(spark, SF_DIR)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        .select(
            F.concat_ws("-", "doc_id", "copy").alias("ord"),
            F.when(F.col("doc_id") % 3 == 0, "hot")
            .otherwise(F.concat_ws("-", F.md5("text"), "copy"))
            .alias("rec_id"),
            F.col("text").alias("position_responsibilities"),
            views.year_of(F.col("n_chars")).alias("year"),
        )
    )
    folder = fresh_folder(spark, "bench")
    copies.write.parquet(folder)
    stored = spark.read.parquet(folder)
    rows = stored.count()
    found = {}
    for name, operator in (
        ("clean", clean.clean_postings),
        ("clean_counts", clean.clean_counts),
    ):
        start = time.perf_counter()
        operator(stored, order_by=("ord",)).write.format("noop").mode("overwrite").save()
        found[name] = round(rows / (time.perf_counter() - start))
    return found


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    documents.groupBy("lang").count().collect()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            spark.catalog.clearCache()  # dimensions that an earlier run cached are built anew
            start = time.perf_counter()
            ENTRIES[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "matched_rows_per_sec": round(documents.count() / seconds["match_top1"]),
                "rows_per_sec": throughput(spark),
            }
        )
    )


if __name__ == "__main__":
    main()
