"""Holds a query's rows against DuckDB SQL over the same tables."""

import math
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def same(df, sql, sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    want = con.sql(sql)
    assert sorted(want.columns) == sorted(df.columns)
    order = sorted(df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(_plain(v) for v in r) for r in want.project(",".join(f'"{c}"' for c in order)).fetchall()), key=repr)
    assert mine == theirs
    return len(mine)
