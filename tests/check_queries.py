"""Run all (or the named) queries against their SQL and print a table: python tests/check_queries.py [name-part ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences, duck_rows, spark_rows  # noqa: E402
from eventloom.session import local_session  # noqa: E402


def main() -> None:
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    parts = sys.argv[1:]
    spark, con = local_session(), connect(sf)
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            got = spark_rows(fn(spark, sf))
            took = time.time() - t0
            t1 = time.time()
            diff = differences(got, duck_rows(con, oracles[name])) if name in oracles else "no oracle"
        except Exception as e:  # noqa: BLE001
            got, took, t1, diff = ([], []), time.time() - t0, time.time(), f"{type(e).__name__}: {str(e)[:600]}"
        flag = "ok" if diff is None else ("--" if diff == "no oracle" else "BAD")
        bad += flag == "BAD"
        print(f"{flag:4}{name:34}{len(got[1]):8} rows {took:6.2f}s duck {time.time() - t1:6.2f}s {diff or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
