"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma list of query names (default: the headline list)

Every query runs to its last row into a no-op sink.  Landed inputs (feed
documents, export files, the archive) are written before and timed on their own
as ``land_*``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from trendloom.plans import catalog, exports, feeds, history
from trendloom.session import recommended_builder

HEADLINE = [
    "ranked_snapshots", "change_history", "filtered_changes", "change_summary", "diff_pair",
    "feed_ingest", "feed_normalized", "feed_envelopes", "export_ingest", "export_normalized", "all_trends",
    "archive_newest", "archive_with_keyword", "keyword_history", "keyword_movement", "compact_history", "archive_stats",
    "interest_over_time", "comparison_table", "region_interest", "related_queries", "payload_comparison",
    "explore_answers", "geo_check", "comparison_check", "answer_reuse", "story_report", "change_stream",
]
#: Rows that flow through a query, for rates: the query that counts them.
RATES = {
    "feed_ingest": "feed trends parsed", "feed_normalized": "feed trends normalized",
    "export_normalized": "export rows normalized", "change_history": "changes found", "change_stream": "changes streamed",
    "answer_reuse": "requests matched",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        recommended_builder(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        started = time.perf_counter()
        action()
        return round(time.perf_counter() - started, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    warm_up = timed(lambda: drain(spark.read.parquet(f"{sf_dir}/region.parquet")))
    seconds = {
        "land_feeds": timed(lambda: feeds.landing(spark, sf_dir)),
        "land_exports": timed(lambda: exports.export_folder(spark, sf_dir)),
        "land_archive": timed(lambda: history.built_archive(spark, sf_dir)),
    }
    rates = {}
    for name in names:
        print(name, file=sys.stderr, flush=True)
        seconds[name] = timed(lambda: drain(catalog.QUERIES[name](spark, sf_dir)))
        if name in RATES:
            rows = catalog.QUERIES[name](spark, sf_dir).count()
            rates[RATES[name] + " per sec"] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "warm_up": warm_up, "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
