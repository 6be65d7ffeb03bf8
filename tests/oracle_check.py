"""Run queries on Spark and their SQL in DuckDB and compare the rows.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((x is not None, str(x) if not isinstance(x, float) else f"{x:.5f}") for x in row)


def _same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(float(a), float(b), abs_tol=1.5e-6, rel_tol=1e-12)
    return a == b


def differences(spark, con, sf_dir: str, name: str, query, sql: str) -> list[str]:
    """Empty if both sides give the same columns and the same rows."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return [f"columns: {names} / {sorted(relation.columns)}"]
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"select {quoted} from ({sql}) q").fetchall(), key=_key)
    if len(ours) != len(theirs):
        return [f"rows: {len(ours)} / {len(theirs)}"]
    return [f"{names}: {a} / {b}" for a, b in zip(ours, theirs) if not all(map(_same, a, b))]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from msgloom.session import local_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark, con = local_session(8), connect(sf_dir)
    every, sql = queries(), oracle_sql()
    failed = 0
    for name in args or every:
        start = time.time()
        try:
            if name in sql:
                found = differences(spark, con, sf_dir, name, every[name], sql[name])
                state = "ok" if not found else f"DIFFERENT ({len(found)})\n    " + "\n    ".join(found[:3])
            else:
                state = f"rows only: {every[name](spark, sf_dir).count()}"
                found = []
        except Exception as error:  # report and go on with the next query
            state, found = f"ERROR {type(error).__name__}: {str(error)[:600]}", ["error"]
        failed += bool(found)
        print(f"{name:32s} {time.time() - start:6.1f}s  {state}", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
