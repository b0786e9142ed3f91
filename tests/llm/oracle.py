"""Compares a query with its SQL twin, as multisets of rows."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


def same(df, sql, sf_dir):
    columns, want = duck(sql, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == columns, (sorted(df.columns), columns)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, bad[:3]
    return len(got)
