"""Compare registered queries with their SQL twins in DuckDB.

Run by hand: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, (float, decimal.Decimal)):
        return "NaN" if math.isnan(value) else f"n:{float(value)!r}"
    if isinstance(value, int):
        return f"n:{float(value)!r}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}={plain(v)}" for k, v in value.items()) + "}"
    return f"s:{value}"


def kind(arrow_type):
    import pyarrow.types as t

    if t.is_string(arrow_type) or t.is_large_string(arrow_type) or "string" in str(arrow_type) and not t.is_nested(arrow_type):
        return "string"
    if t.is_timestamp(arrow_type):
        return "timestamp"
    if t.is_list(arrow_type) or t.is_large_list(arrow_type):
        return f"list<{kind(arrow_type.value_type)}>"
    return str(arrow_type)


def rows_of(arrow):
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return sorted("|".join(plain(v) for v in row) for row in zip(*columns)) if names else []


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a message."""
    got = query(spark, sf_dir).toArrow()
    want = con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    for column in got.column_names:
        a, b = kind(got.schema.field(column).type), kind(want.schema.field(column).type)
        if a != b:
            return f"type of {column}: {a} != {b}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    left, right = rows_of(got), rows_of(want)
    for a, b in zip(left, right):
        if a != b:
            k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            return f"value {a[max(0, k - 80):k + 120]!r} != {b[max(0, k - 80):k + 120]!r}"
    return None


def main():
    from kliping.queries import ORACLE, QUERIES, load_all
    from kliping.session import build_session

    load_all()
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            if name in ORACLE:
                message = compare(spark, con, name, query, ORACLE[name], sf_dir)
            else:
                message = None
                print(f"   {name}: rows only, {query(spark, sf_dir).toArrow().num_rows}")
        except Exception as error:  # shown, not raised: the run goes on
            message = f"{type(error).__name__}: {str(error)[:700]}"
        bad += message is not None
        n = con.execute(f"select count(*) from ({ORACLE[name]})").fetchone()[0] if name in ORACLE and message is None else ""
        print(f"{'ok ' if message is None else 'BAD'} {name} {time.time() - start:.2f}s {n} {message or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
