"""Run queries and their SQL side by side: ``python tests/compare.py SF_DIR [name…]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def oracle(folder: str):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def compare(spark, connection, folder: str, function, sql: str | None) -> str:
    """``''`` when equal, else what differs."""
    frame = function(spark, folder)
    got = frame.collect()
    if sql is None:
        return "" if got else "no rows"
    answer = connection.execute(sql)
    columns = [c[0] for c in answer.description]
    wanted = answer.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    left, right = rows_of(frame.columns, got), rows_of(columns, wanted)
    if not right:
        return "the SQL gives no rows"
    if left != right:
        first = next(((a, b) for a, b in zip(left, right) if a != b), ("", ""))
        return f"{len(left)} rows against {len(right)}; first difference {first}"
    return ""


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from extractkit.session import local_session

    spark = local_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.perf_counter()
        try:
            problem = compare(spark, connection, folder, queries[name], sql.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.perf_counter() - started:6.2f}s "
              f"{'' if sql.get(name) else '(rows only) '}{problem}", flush=True)
    print(f"{len(names or queries) - bad} of {len(names or queries)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
