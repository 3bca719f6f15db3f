"""Compare a registered query with its SQL in DuckDB: same columns, same rows, same values, bit for bit."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def compare(df, connection, sql):
    """A list of complaints, empty if the results agree."""
    ours_columns = sorted(df.columns)
    cursor = connection.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    if ours_columns != sorted(theirs_columns):
        return [f"columns differ: {sorted(set(ours_columns) ^ set(theirs_columns))}"]
    order = [theirs_columns.index(c) for c in ours_columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*ours_columns).collect())
    complaints = []
    if sum(ours.values()) != sum(theirs.values()):
        complaints.append(f"{sum(ours.values())} rows, expected {sum(theirs.values())}")
    if ours != theirs:
        complaints.append(f"unexpected {list((ours - theirs).items())[:2]}, missing {list((theirs - ours).items())[:2]}")
    kinds = {type(v) for row in list(ours)[:50] for v in row} - {type(None)}
    other = {type(v) for row in list(theirs)[:50] for v in row} - {type(None)}
    if kinds != other:
        complaints.append(f"value types differ: {kinds} and {other}")
    return complaints
