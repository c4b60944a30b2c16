"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_QUERIES (comma-separated names).
Each query writes all its rows to Spark's no-op sink; the better of two runs counts. ``rows_per_second`` times reads of stored
bars of 48 columns (the shape of the published single-symbol reads): all columns, three columns, and all columns of one symbol.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from barspan import build_session
from barspan.plans.queries import QUERIES
from barspan.session import scratch_dir

HEADLINE = [
    # Reads
    "full_table", "range_read_both", "last_n_per_symbol", "cross_section_tags", "last_n_days", "dense_grid",
    # Adjustment and resampling
    "forward_adjust", "previous_close", "asof_adjust_multiply", "asof_adjust_merged", "forward_fill", "klines",
    "resample_week", "resample_month", "bars_5min", "series_by_symbol",
    # Market statistics and membership
    "market_breadth", "recent_limit_up", "limitup_concepts", "top_rank_concepts", "hot_list", "market_stats",
    "members_of_index", "top_concepts", "concepts_per_stock",
    # Calendar, times, statements
    "align_to_calendar", "calendar_dimension", "normalise_timestamps", "statements_clean", "statements_merge",
    # Ingest and maintenance
    "csv_ingest", "upsert", "delete", "schema_evolution", "day_merge", "limitup_concepts_days", "statements_merge_salted",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def _seconds(df) -> float:
    best = float("inf")
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def stored_reads(spark, sf_dir: str) -> dict[str, int]:
    """Rows per second of reads from a table of 48 columns made from the order lines, laid out by symbol and time."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    values = [F.round(F.col("l_extendedprice") * (1 + F.lit(i) / 97), 2).alias(f"c{i}") for i in range(46)]
    bars = lines.select(F.col("l_suppkey").cast("string").alias("symbol"), F.col("l_shipdate").cast("timestamp_ntz").alias("dt"), *values)
    path = scratch_dir(spark, "bench")
    bars.repartitionByRange("symbol", "dt").sortWithinPartitions("symbol", "dt").write.parquet(path)
    stored = spark.read.schema(bars.schema).parquet(path)
    one = stored.where(F.col("symbol") == stored.agg(F.min("symbol")).first()[0])
    reads = {"wide": stored, "narrow": stored.select("dt", "c0", "c1"), "one_symbol_wide": one}
    return {name: round(df.count() / _seconds(df)) for name, df in reads.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "barspan-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    timed(spark, "symbol_names", sf_dir)
    seconds = {name: round(min(timed(spark, name, sf_dir) for _ in range(2)), 4) for name in names}
    print(
        json.dumps(
            {"metric": "total_query_time", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds,
             "rows_per_second": stored_reads(spark, sf_dir), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
