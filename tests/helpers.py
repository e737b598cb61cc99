from __future__ import annotations

import datetime as dt
import decimal


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(round(float(x), 6) for x in v.toArray())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def rows_of(df):
    return canon(df.columns, df.collect())


def duck(sql: str, sf_dir: str):
    import duckdb

    from forgeline.sources.tables import DRIVER_TABLES, table_path

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()
