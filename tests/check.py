"""Run queries against DuckDB and print what differs: python tests/check.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        started = time.time()
        try:
            df = fn(spark, sf_dir)
            verdict = difference(df, con, sql[name]) if name in sql else f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None and not verdict.startswith("rows only")
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if verdict is None else verdict}", flush=True)
    print(f"{bad} differ")
