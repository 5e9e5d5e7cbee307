"""Compare query results with their SQL on DuckDB: column names, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if expected == actual:
        return None
    lost, extra = expected - actual, actual - expected
    return (f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
            f"{sum(lost.values())} lost e.g. {list(lost)[:2]}; {sum(extra.values())} extra e.g. {list(extra)[:2]}")


def main() -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as contract
    from logweir.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, failed = local_session(8), database(sf_dir), 0
    oracles = contract.oracle_sql()
    for name, run in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            found = difference(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
