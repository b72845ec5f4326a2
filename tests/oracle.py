"""Compare a Spark result with the SQL counterpart run by DuckDB on the same tables."""

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(map(_plain, value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "BIGINT": "int", "INTEGER": "int", "double": "float",
    "DOUBLE": "float", "string": "str", "VARCHAR": "str", "boolean": "bool", "BOOLEAN": "bool", "HUGEINT": "huge",
    "date": "date", "DATE": "date", "timestamp_ntz": "ts", "TIMESTAMP": "ts", "timestamp": "tz",
}


def compare(df, con, sql):
    """None when equal, else a short description."""
    relation = con.execute(sql)
    theirs_columns = [d[0] for d in relation.description]
    theirs_types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in relation.description}
    theirs = rows_of(theirs_columns, relation.fetchall())
    ours_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    ours = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}"
    if ours_types != theirs_types:
        return f"types {sorted(set(ours_types.items()) ^ set(theirs_types.items()))}"
    if ours != theirs:
        return f"{sum(ours.values())} rows, oracle {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}; only oracle {list((theirs - ours).items())[:3]}"
    return None if ours else "empty result"
