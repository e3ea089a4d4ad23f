"""Compares queries with their SQL on one scale folder.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", __import__("os").environ.get("SESSION_ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
    "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str, run, sql: str | None):
    """Null if equal, else what differs."""
    df = run(spark, folder)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if mine else "no rows"
    cursor = con.execute(sql)
    head = cursor.description
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(d[0] for d in head):
        return f"columns {sorted(df.columns)} / {sorted(d[0] for d in head)}"
    kinds = dict(df.dtypes)
    for d in head:
        if _KINDS.get(str(d[1]), str(d[1])) != kinds[d[0]]:
            return f"type of {d[0]}: {kinds[d[0]]} / {d[1]}"
    if not mine:
        return "no rows"
    left, right = _bag(df.columns, mine), _bag([d[0] for d in head], theirs)
    if left != right:
        only_left, only_right = list(left - right)[:2], list(right - left)[:2]
        return f"rows {left.total()} / {right.total()}: {only_left} / {only_right}"
    return None


def main() -> int:
    from catalog import ORACLES, QUERIES

    arguments = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if arguments and arguments[0].startswith("/"):
        folder = arguments.pop(0)
    names = [n for n in QUERIES if not arguments or any(n.startswith(a) for a in arguments)]
    spark, con = session(), duck(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        state = "ok" if problem is None else "FAILED " + problem
        print(f"{name:36s} {time.time() - start:6.1f}s {state}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
