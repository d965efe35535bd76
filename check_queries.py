"""Run registered queries next to their SQL in DuckDB and compare columns, types and values.

usage: python check_queries.py [scale folder] [name or prefix* ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

from lake_queries import ORACLES, QUERIES
from telemetry_lake import build_session

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value: object) -> object:
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        count = df.count()
        return None if count > 0 else "no rows"
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    for column, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[column]:
            return f"type of {column}: {kind} / {types[column]}"
    order = sorted(names)
    spots = [names.index(n) for n in order]
    theirs = Counter(tuple(plain(row[i]) for i in spots) for row in cursor.fetchall())
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in order]).collect())
    if ours == theirs:
        return None if ours else "no rows"
    extra, lacking = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}; columns {order}; only ours {list(extra)[:3]}; "
        f"only theirs {list(lacking)[:3]}"
    )


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    wanted = [n for n in QUERIES if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal, {len(QUERIES)} registered, {len(ORACLES)} with SQL")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
