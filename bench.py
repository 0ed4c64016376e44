"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query runs once to warm up and then BENCH_RUNS times, of which the median counts. Rows are
produced in full and thrown away, and everything a query parks on the way is part of its time.

Each test table is one Parquet row group, which one task reads, whatever the number of cores. So before the clock starts the
larger tables are written once as several files, as any table of size is stored.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import all_checks  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

HEADLINE = [
    "p8_gold_wide",
    "a1_daily_sales",
    "a2_product_performance",
    "a3_geography_performance",
    "k1_revenue_kpi",
    "k2_product_performance",
    "k3_customer_segments",
    "k4_geography_insights",
    "w5_dense_rank_in_group",
    "m1_metric_by_dimension",
    "m3_payer_market_share_by_state",
    "n3_covered_lives_by_clinic_territory",
    "n7_payer_market_share",
    "n9_payer_share_ranked_in_state",
    "n15_coverage_gap_by_state",
    "d2_orphans_by_relationship",
    "s7_assemble_documents",
    "t1_chunk_documents",
    "t2_clean_line",
    "t4_extract_lines",
    "t5_dedupe_lines",
    "t9_classify_lines",
    "v1_embed_documents",
    "v4_nearest_batch",
    "v5_nearest_approximate",
    "x4_get_product_profile",
    "x5_search_docs",
    "r1_incremental_refresh",
]


SPLIT_BYTES = 500_000


def split_tables(spark, sf_dir: str, folder: str, files: int) -> str:
    """The tables of ``sf_dir`` in ``folder``, those of over SPLIT_BYTES in ``files`` files; rows stay as they are."""
    for name in sorted(n for n in os.listdir(sf_dir) if n.endswith(".parquet")):
        source = os.path.join(sf_dir, name)
        rows = spark.read.parquet(source)
        parts = files if os.path.isfile(source) and os.path.getsize(source) > SPLIT_BYTES else 1
        rows.repartition(parts).write.parquet(os.path.join(folder, name))
    return folder


def run(spark, sf_dir: str, key: str) -> float:
    started = time.perf_counter()
    all_checks.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    timings, folder = {}, tempfile.mkdtemp(prefix="bench-")
    tables = split_tables(spark, sf_dir, folder, int(cpus))
    for key in keys:
        run(spark, tables, key)
        timings[key] = round(statistics.median(run(spark, tables, key) for _ in range(runs)), 3)
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
