"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Every
query runs twice and the better time counts, so that JVM start-up is not what is measured. All
rows are computed and sent to Spark's no-op sink. Hour files are landed before timing starts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.operators.fact import fact_events  # noqa: E402
from tidemark.operators.silver import transform_events  # noqa: E402
from tidemark.plans import fixture  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources.bronze import read_bronze  # noqa: E402
from tidemark.sources.fact import read_fact, write_fact  # noqa: E402

HEADLINE = [
    "stg_events",
    "dim_repo",
    "dim_actor",
    "fact_events",
    "trending_repos_daily",
    "language_momentum",
    "contributor_leaderboard",
    "language_enrichment",
    "dq_suite_verdict",
    "dq_relationships",
    "mart_reconciliation",
    "run_history",
    "serve_trending_page",
    "serve_momentum_page",
    "serve_leaderboard_page",
    "fact_upsert",
]


def silver_from_hour_files(spark, sf_dir):
    """Parse, flatten, type and de-duplicate every landed hour file."""
    return transform_events(read_bronze(spark, fixture.landed_bronze(spark, sf_dir)))


def fact_full_write(spark, sf_dir):
    path = scratch_path(spark, "fact")
    write_fact(spark, path, fact_events(fixture.staging(spark, sf_dir)), full_refresh=True)
    return read_fact(spark, path)


def timed(spark, query, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixture.landed_bronze(spark, sf_dir)
    work = {name: QUERIES[name] for name in HEADLINE}
    work["silver_from_hour_files"] = silver_from_hour_files
    work["fact_full_write"] = fact_full_write
    times = {
        name: round(min(timed(spark, query, sf_dir) for _ in range(2)), 3)
        for name, query in work.items()
    }
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
