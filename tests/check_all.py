"""Run every query at a scale and compare it with its SQL: python -m tests.check_all [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as spark_entry
from tests.compare import connect, differences, duckdb_rows, spark_rows
from wayfare.session import local_session


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a] or list(spark_entry.queries())
    spark = local_session("check")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            got = spark_rows(spark_entry.queries()[name](spark, sf_dir))
            sql = spark_entry.oracle_sql().get(name)
            problem = differences(got, duckdb_rows(connection, sql)) if sql else None
            note = "ok" if sql else "rows only"
        except Exception as error:  # noqa: BLE001
            got, problem, note = ([], []), f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{name:28} {len(got[1]):8} rows {time.time() - begin:6.2f} s  {problem or note}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
