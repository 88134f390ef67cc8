"""Compare a registered query with its SQL statement on the same tables."""

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return con


def compare(df, con, sql):
    """Column names and multiset of rows; returns a description of the difference or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = [names.index(c) for c in df.columns]
    want = Counter(tuple(row[i] for i in order) for row in expected)
    got = Counter(tuple(row) for row in df.collect())
    if want == got:
        return None
    extra, missing = list((got - want).elements()), list((want - got).elements())
    return (
        f"{sum(got.values())} rows for {sum(want.values())}; extra {extra[:3]}; missing {missing[:3]}"
    )
