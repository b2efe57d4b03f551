"""Run ``entry`` and every registered query the way a driver would.

A plain session (``local[*]``, 8 shuffle partitions, none of the library's
settings) and the entry module loaded by file path.

Usage: python tools/run_all.py [sf_dir]
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time

from pyspark.sql import SparkSession


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("entry_mod", os.path.join(here, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    print("entry rows", mod.entry(spark).count())
    bad, t0 = 0, time.time()
    for key, fn in mod.queries().items():
        t = time.time()
        try:
            n = fn(spark, sf).count()
            print(f"{key:28s} {n:8d} rows {time.time() - t:6.1f}s")
        except Exception as exc:  # report and go on
            bad += 1
            print(f"FAIL {key}: {str(exc)[:200]}")
    print(f"queries {len(mod.queries())} failures {bad} total {time.time() - t0:.1f}s")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
