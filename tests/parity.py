"""Run registered queries and their SQL twins side by side and compare every value."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(folder: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def compare(spark, con, name: str, folder: Path) -> str:
    """Empty string when equal, else a description of the difference."""
    from textlake.catalog import ORACLES, QUERIES

    df = QUERIES[name](spark, str(folder))
    columns = sorted(df.columns)
    left = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        return "" if left else "no rows"
    result = con.sql(ORACLES[name])
    theirs = sorted(result.columns)
    if columns != theirs:
        return f"columns {columns} != {theirs}"
    kinds = dict(zip(result.columns, [str(t) for t in result.types], strict=True))
    wide = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = [f"{c}:{t}!={kinds[c]}" for c, t in df.dtypes if wide.get(t) != kinds[c]]
    order = [result.columns.index(c) for c in theirs]
    right = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if left == right:
        return f"types {types}" if types else ""
    only_l, only_r = left - right, right - left
    return (
        f"rows {left.total()} vs {right.total()}; only spark {only_l.total()}: {list(only_l)[:3]}; "
        f"only sql {only_r.total()}: {list(only_r)[:3]} {types}"[:1500]
    )


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tests.conftest import make_session
    from textlake.catalog import ORACLES, QUERIES

    folder = TESTDATA / argv[0]
    names = argv[1:] or list(QUERIES)
    spark, con, bad = make_session(), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            diff = compare(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            diff = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(diff)
        mark = "ok  " if not diff else "FAIL"
        print(f"{mark} {'S' if name in ORACLES else 'R'} {time.time() - start:6.1f}s {name} {diff}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
