"""Rows of a DataFrame and of SQL in DuckDB, in any order."""

from pathlib import Path


def _cell(v):
    if v is None or v != v:
        return "null"
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def same_rows(df, sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(_cell(r[names.index(c)]) for c in df.columns) for r in found.fetchall())
    got = sorted(tuple(_cell(v) for v in r) for r in df.collect())
    assert got == want
