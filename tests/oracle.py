"""Compare registered queries with their SQL. Run as a script to check one scale or query:

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# ---- Fixed values: the given tables ----
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# ---- Fixed values: result types of the SQL engine and of Spark ----
SPARK_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "STRING": "string",
               "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both sides have the same columns, types of values and rows."""
    result = con.execute(sql)
    theirs = sorted(d[0] for d in result.description)
    order = [d[0] for d in result.description]
    expected = result.fetchall()
    ours = sorted(df.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    at = [order.index(c) for c in ours]
    kinds = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    unlike = {c: (t, kinds[c]) for c, t in df.dtypes if t != kinds[c]}
    if unlike:
        return f"types {unlike}"
    expected = sorted(tuple(map(repr, (row[i] for i in at))) for row in expected)
    actual = sorted(tuple(map(repr, row)) for row in df.select(*ours).collect())
    if actual == expected:
        return None
    lost = [r for r in expected if r not in set(actual)][:2]
    extra = [r for r in actual if r not in set(expected)][:2]
    return f"{len(actual)} rows, expected {len(expected)}\n  missing {lost}\n  extra {extra}"


def main() -> None:
    from salesmart.checks.oracle import ORACLE
    from salesmart.checks.queries import QUERIES
    from salesmart.session import local_session

    sf_dir, *names = sys.argv[1:]
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = difference(df, con, ORACLE[name]) if name in ORACLE else None
            if name not in ORACLE:
                df.collect()
        except Exception as error:  # report every query, whatever went wrong in one
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:32s} {time.time() - begin:6.2f}s {'ok' if not found else found}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
