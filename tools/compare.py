"""Runs a registered query and its SQL on the same tables and compares every value."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted([tuple(_plain(r[c]) for c in columns) for r in df.collect()], key=_key)


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted([tuple(_plain(r[i]) for i in order) for r in cur.fetchall()], key=_key)


def difference(got, want):
    """None when equal, otherwise what differs first."""
    (cols, rows), (names, expected) = got, want
    if cols != names:
        return f"columns {cols} / {names}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} / {len(expected)}"
    if rows != expected:
        diff = [(a, b) for a, b in zip(rows, expected) if a != b]
        return f"{len(diff)} rows differ, e.g. {diff[0]}"

    def kinds(r):
        return [sorted({type(x[i]).__name__ for x in r if x[i] is not None}) for i in range(len(cols))]

    if kinds(rows) != kinds(expected):
        return f"types {list(zip(cols, kinds(rows), kinds(expected)))}"
    return None
