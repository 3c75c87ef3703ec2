"""Compare Spark results with DuckDB results, row by row, ignoring order."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(frame):
    return bag(frame.columns, [tuple(row) for row in frame.collect()])


def duck_bag(con, sql):
    relation = con.sql(sql)
    return bag(relation.columns, relation.fetchall()), relation



def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def check_plan(frame):
    """No join of everything with everything, no Python, and a window without groups
    only over the row counts of the range partitions."""
    text = plan(frame)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in text, node
    for line in text.splitlines():
        if re.search(r"Window \[", line) and "_rows" not in line:
            assert re.search(r"\], \[\w+#\d+.*\], \[", line), line
