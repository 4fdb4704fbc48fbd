"""Time the headline queries: prints one JSON line. BENCH_SQL=1 times DuckDB on the same questions instead."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# One or two queries of every operator family; BENCH_ALL=1 times all registered queries.
HEADLINE = [
    "conditional_summary", "covers_all", "first_period_rows", "next_day_return_rate", "value_as_of",
    "last_within_cap", "dense_rank_many_values", "top_n_dense", "rate_with_role_filters",
    "category_pairs", "season_leader", "last_n_increasing", "cyclic_sequence", "transition_counts",
    "dominant_share", "consecutive_runs", "top_degree", "asof_row_join", "ordered_concat",
    "change_log_latest", "row_fingerprint", "claim_snapshot", "working_seconds", "metric_union",
    "period_edge_estimates", "kpi_dataset", "kpi_dataset_opening", "formula_metrics", "pivot_with_total", "xml_rows",
    "open_lines", "allocate_fifo", "scan_out", "document_numbers", "movement_lines", "profile", "monthly_trend",
    "pivot_sum", "session_summary_stream",
]


def make_session(name: str = "bench") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sql_seconds(path: str, names: list[str]) -> dict[str, float]:
    import duckdb

    from check import TABLES
    from tallyworks.plans import oracle_sql

    db, sql, seconds = duckdb.connect(), oracle_sql(), {}
    db.execute(f"SET threads = {os.environ.get('BENCH_CPUS', '8')}")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    for name in names:
        started = time.time()
        db.execute(sql[name]).fetchall()
        seconds[name] = round(time.time() - started, 3)
    return seconds


def main() -> None:
    from tallyworks.plans import queries

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    known = queries()
    names = list(known) if os.environ.get("BENCH_ALL") else HEADLINE
    if os.environ.get("BENCH_SQL"):
        seconds = sql_seconds(path, names)
    else:
        spark, seconds = make_session(), {}
        spark.read.parquet(f"{path}/orders.parquet").count()
        for name in names:
            started = time.time()
            known[name](spark, path).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
