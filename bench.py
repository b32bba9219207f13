"""Times headline queries; prints one JSON line.

Every query runs in full: its result goes to Spark's no-op sink, which computes
all rows and columns and stores none. Queries that write tables do write them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from gridlake.queries import QUERIES
from gridlake.queries.registry import Tables
from gridlake.session import build_session, fresh_path

HEADLINE = [
    "hourly_rollup", "daily_stats", "coverage", "series_arrays", "latest_executions",
    "dispatch_summary", "lmp_statistics", "execution_report", "dispatch_lmp_join",
    "dispatch_lmp_keyed", "convergence_status", "asof_topology", "rules_report",
    "rules_by_case", "result_gate", "gap_check", "ramp", "cumulative_time", "asof_forecast",
    "generator_year", "load_factor_series", "synthetic_noise", "hydro_share", "area_load",
    "case_generators", "document_generators", "scenario_dispatch", "scenario_totals",
    "residuals", "multipliers", "objective", "lp_objective", "lp_densify", "lp_balance",
    "csv_generators", "table_roundtrip", "stream_hourly", "stream_dedupe", "refresh_rollup",
    "forecast",
]


def year_load(spark, directory: str) -> int:
    """A year of 8760 hours built and appended by date for every supplier as a unit."""
    from gridlake.operators.series import generator_year
    from gridlake.sinks.tables import append_measurements

    frame = Tables(spark, directory).supplier.select(
        F.lit("SUPPLIERS").alias("case_name"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("bus_number"),
        F.lit(10.0).alias("pmin"),
        (F.abs("s_acctbal") + 10).alias("pmax"),
        F.lit("Coal").alias("fuel"),
        F.lit(30.0).alias("marginal_cost"),
    )
    path = fresh_path(spark, "year")
    append_measurements(generator_year(frame), path, entity="generator_id")
    return spark.read.parquet(path).count()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["rows_per_table"](spark, directory).collect()  # start the engine
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline query time",
        "value": 0.0,
        "unit": "sec",
        "queries": times,
        "sf": directory.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    if len(sys.argv) == 1:
        start = time.perf_counter()
        rows = year_load(spark, directory)
        times["year_load"] = round(time.perf_counter() - start, 3)
        result["year_load_rows"] = rows
        result["year_load_rows_per_sec"] = round(rows / times["year_load"])
    result["value"] = round(sum(times.values()), 3)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
