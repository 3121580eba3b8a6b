"""Run registered queries next to their SQL statements and compare rows.

    python tools/compare.py [--folder DIR] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordwell.catalog import ORACLES, QUERIES  # noqa: E402
from recordwell.session import local_session  # noqa: E402


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, df.collect())
    took = time.time() - started
    if name not in ORACLES:
        return True, f"{len(mine)} rows, no statement, {took:.1f}s"
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    started = time.time()
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    other = time.time() - started
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), (mine[len(theirs):][:1], theirs[len(mine):][:1]))
        return False, f"{len(mine)} rows against {len(theirs)}; first difference {str(first)[:600]}"
    return True, f"{len(mine)} rows, {took:.1f}s (sql {other:.1f}s)"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    failed = 0
    for name in args.names or QUERIES:
        try:
            good, note = compare(spark, args.folder, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
