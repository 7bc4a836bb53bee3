"""Order-insensitive comparison of a Spark DataFrame with DuckDB SQL on the same Parquet files."""
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
_CONS = {}


def duck(sf):
    if sf not in _CONS:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        _CONS[sf] = con
    return _CONS[sf]


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows_of(names, rows, order):
    idx = [names.index(c) for c in order]
    return Counter(tuple(_norm(r[i]) for i in idx) for r in rows)


def compare(sdf, sql, sf):
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck(sf).sql(sql)
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns), (sdf.columns, rel.columns)
    order = sorted(sdf.columns)
    a, b = rows_of(sdf.columns, srows, order), rows_of(rel.columns, drows, order)
    assert len(srows) == len(drows), (len(srows), len(drows))
    assert a == b, (list((a - b).elements())[:3], list((b - a).elements())[:3])
    return len(srows)
