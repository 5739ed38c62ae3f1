"""Compare registered queries with their SQL: ``python tests/oracle.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return names, sorted(zip(*columns), key=key)


def compare(spark, con, query, sql, sf_dir: str) -> str:
    """Empty when names, types and values agree, else what differs."""
    ours, theirs = query(spark, sf_dir).toArrow(), con.sql(sql).to_arrow_table()
    kind = lambda t: str(t).replace("large_", "").split("[")[0]
    types = lambda t: {f.name: kind(f.type) for f in t.schema}
    if types(ours) != types(theirs):
        return f"schema {types(ours)} != {types(theirs)}"
    (_, a), (_, b) = _rows(ours), _rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row\n  {str(x)[:700]}\n  {str(y)[:700]}"
    return ""


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from pagemill.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                result = compare(spark, con, query, sqls[name], sf_dir)
                result = result and f"DIFFERS {result}" or "equal"
            else:
                result = f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception:
            result = "ERROR " + traceback.format_exc(limit=-2)[:1500]
        failed += result.startswith(("DIFFERS", "ERROR"))
        print(f"@{name:22s} {time.time() - start:6.1f}s {result}", flush=True)
    print(f"@{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
