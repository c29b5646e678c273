"""Run every registered query against its DuckDB oracle (like the driver).

usage: python tests/run_oracles.py [sf_dir] [name ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from fleetscope.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                ok, msg = compare(df, sf_dir, sqls[name])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.1f}s {msg}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
