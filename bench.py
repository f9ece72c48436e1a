"""Times the headline queries over whole tables; prints one JSON line.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tablex import configure
from tablex.plans.registry import QUERIES

HEADLINES = [
    "project_columns",
    "filter_date_range",
    "extract_top",
    "self_join_names",
    "normalize_types_double",
    "normalize_types_decimal",
    "numeric_decimal",
    "text_roundtrip_lineitem",
    "text_roundtrip_documents",
    "write_read_parquet",
    "write_read_csv",
    "csv_cells",
    "stream_export",
    "extract_count",
    "table_profile",
    "catalog_dictionary",
    "cell_diff",
    "cell_diff_copies",
    "diff_report",
    "reconcile",
    "fingerprint",
    "fingerprint_lineitem",
    "agg_filter",
    "string_agg_ordered",
    "generated_rows",
    "wide_1000",
    "chained_joins",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablex-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(df: DataFrame) -> None:
    """Compute every row and cell, keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    run(QUERIES["write_read_parquet"](spark, folder))
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        run(QUERIES[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
