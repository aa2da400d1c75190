"""python tests/check.py [sf] [name ...]: compare registered queries with DuckDB and time them."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.oracle import compare, duck

if __name__ == "__main__":
    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                note = compare(fn(spark, sf), con, sqls[name])
            else:
                note = None if (n := fn(spark, sf).count()) > 0 else "no rows"
        except Exception as error:
            note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += note is not None
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.2f}s {'' if name in sqls else '(rows)'} {note or ''}", flush=True)
    print("failed", failed)
