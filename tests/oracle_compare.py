"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime
import math
import time

import duckdb

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if not isinstance(value, str) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, build, sql, sf_dir):
    started = time.time()
    df = build(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    spark_s = time.time() - started
    started = time.time()
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    duck_s = time.time() - started
    problems = []
    if ours[0] != theirs[0]:
        problems.append(f"columns {set(ours[0]) ^ set(theirs[0])}")
    elif len(ours[1]) != len(theirs[1]):
        problems.append(f"rows {len(ours[1])} != {len(theirs[1])}")
    else:
        for a, b in zip(ours[1], theirs[1]):
            if a != b:
                problems.append(str([(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y]))
    return len(ours[1]), problems, spark_s, duck_s
