"""Compare a query with its SQL over the same tables, as multisets of rows."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Column types that count as equal between the two engines.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} / {sorted(theirs)}"
    types = {c: (ours[c], theirs[c]) for c in ours if TYPES.get(ours[c]) != theirs[c]}
    if types:
        return f"types {types}"
    expected = _rows(list(theirs), result.fetchall())
    got = _rows(df.columns, df.collect())
    if got != expected:
        return (
            f"rows {sum(got.values())} / {sum(expected.values())}; only ours {list((got - expected).items())[:2]}; "
            f"only sql {list((expected - got).items())[:2]}"
        )
    return None if expected else "empty"
