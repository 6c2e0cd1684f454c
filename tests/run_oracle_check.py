"""Run every registered query against its DuckDB oracle; print a summary.

Usage: python tests/run_oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from dq_mart.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_session("oracle-check", master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k in sqls:
                r = compare(df, con, sqls[k])
                ok = r["values_match"] and r["spark_rows"] == r["oracle_rows"]
            else:
                n = df.count()
                r, ok = {"spark_rows": n, "oracle": None}, True
        except Exception as e:  # noqa: BLE001
            r, ok = {"error": f"{type(e).__name__}: {str(e)[:600]}"}, False
        bad += not ok
        status = "OK " if ok else "BAD"
        print(f"\n{status} {k:32s} {time.time()-t0:6.2f}s {json.dumps(r, default=str)[:900]}",
              flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
