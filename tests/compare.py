"""Compare registered queries with their DuckDB counterparts; also a script: compare.py SF_DIR [query ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def oracle_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
          "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con, sql):
    """None when both give the same columns, types and rows; otherwise a short description."""
    names, expected = oracle_rows(con, sql)
    kinds = dict((r[0], r[1]) for r in con.execute(f"describe {sql}").fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = {c: _KINDS.get(k, k.upper()) for c, k in df.dtypes}
    theirs = {c: k.replace(" ", "") for c, k in kinds.items()}
    off = {c: (ours[c], theirs[c]) for c in names if ours[c] != theirs[c]}
    if off:
        return f"types {off}"
    order = sorted(names)
    got = sorted(([repr(r[c]) for c in order] for r in df.collect()))
    want = sorted([repr(v) for v in (row[names.index(c)] for c in order)] for row in expected)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {dict(zip(order, a))} != {dict(zip(order, b))}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    con = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("keys without a counterpart:", sorted(set(queries) ^ set(oracle)))
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            found = difference(queries[name](spark, sf_dir), con, oracle[name])
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
