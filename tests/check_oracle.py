"""Run registered queries next to their SQL: python tests/check_oracle.py [dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, duckdb_rows, spark_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as driver  # noqa: E402


def main(sf_dir, *names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    for name, run in driver.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            want = duckdb_rows(con, driver.oracle_sql()[name])
        except Exception as error:  # report and go on
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            bad.append(name)
            continue
        same = got == want
        print(f"{'ok   ' if same else 'DIFF '}{name} {len(got[1])} rows {time.time() - began:.1f}s", flush=True)
        if not same:
            bad.append(name)
            print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            left, right = set(map(repr, got[1])), set(map(repr, want[1]))
            print("  spark only", sorted(left - right)[:3])
            print("  duckdb only", sorted(right - left)[:3])
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(*args))
