"""Comparison of a Spark result with a DuckDB result, rows in any order."""

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SPARK_AS_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql):
    """What differs, as text; empty if nothing does."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    wanted = rows_of(names, expected.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    for name, kind in df.dtypes:
        if SPARK_AS_DUCK.get(kind) != kinds[name]:
            return f"column {name} is {kind} instead of {kinds[name]}"
    if not wanted:
        return "the expected result is empty"
    if found != wanted:
        extra = sorted(set(found) - set(wanted))[:3]
        missing = sorted(set(wanted) - set(found))[:3]
        return f"{len(found)} rows instead of {len(wanted)}; extra {extra}; missing {missing}"
    return ""
