"""Print column types that differ between a query and its oracle."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from fleetscope.session import build_session  # noqa: E402
from oracle_util import TABLES  # noqa: E402

CANON = {"bigint": "int64", "BIGINT": "int64", "int": "int32", "INTEGER": "int32", "double": "float64",
         "DOUBLE": "float64", "string": "string", "VARCHAR": "string", "boolean": "bool", "BOOLEAN": "bool",
         "timestamp_ntz": "timestamp", "TIMESTAMP": "timestamp", "timestamp": "timestamptz",
         "TIMESTAMP WITH TIME ZONE": "timestamptz", "HUGEINT": "int128"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, fn in E.queries().items():
        st = {c: CANON.get(t, t) for c, t in fn(spark, sf).dtypes}
        rel = con.sql(E.oracle_sql()[name])
        dt = {c: CANON.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        print(("TYPES " if diff else "ok    ") + name, diff if diff else "", flush=True)


if __name__ == "__main__":
    main()
