"""Time the headline queries and print one JSON line.

Every query is run to its end with the ``noop`` sink, so all rows and columns
are computed and nothing is collected. It runs twice: ``queries`` holds the
second times, ``first_pass`` those of the cold session. ``BENCH_SF_DIR`` names the tables and
``BENCH_CPUS`` the threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kliping.queries import QUERIES, load_all  # noqa: E402
from kliping.session import build_session  # noqa: E402

HEADLINE = [
    "article_table", "extract_fields", "harvest", "html_text", "drop_phrases", "parse_dates_id",
    "listing_links", "listing_items", "new_links", "new_links_like", "until_first_seen", "first_by_url", "load_outcome",
    "insert_if_absent", "repair_merge", "coverage_rollup", "missing_days", "key_collisions", "fill_rates",
    "publish_gaps", "latest_n", "frequent_lines", "csv_roundtrip", "dump_rescue",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load_all()
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(max(8, int(cpus) if cpus.isdigit() else 8)),
        spark__ui__enabled="false", spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__files__maxPartitionBytes="1m", spark__checkpoint__dir=tempfile.mkdtemp(prefix="kliping-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    # A first pass starts the workers and compiles; its times are given apart.
    first = {name: round(run(spark, name, sf_dir), 3) for name in chosen}
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in chosen}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_pass": first,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "pages_per_second": round(pages / seconds["extract_fields"], 1) if "extract_fields" in seconds else None,
            }
        )
    )


if __name__ == "__main__":
    main()
