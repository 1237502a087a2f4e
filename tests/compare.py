"""Compare a registered query with its SQL on the same tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in place) for r in rows), key=repr)


def differences(df, con, sql):
    """Empty when row counts, columns, value types and values agree."""
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(set(df.columns) ^ set(columns))}"]
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} and {len(theirs)}", str(mine[:2]), str(theirs[:2])]
    names = sorted(columns)
    out = []
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(str([(n, x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]))
            if len(out) == 3:
                break
    return out
