"""Compare a query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when column names, rows and kinds of types agree, else a short account of the first difference."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; only here {[g for g in got if g not in set(want)][:2]}, missing {[w for w in want if w not in set(got)][:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ: {bad[0]}"
    alike = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT"}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = [(n, t, kinds[n]) for n, t in types.items() if t in alike and alike[t] != kinds[n] and kinds[n] != "STRING"]
    return f"types {odd}" if odd else None
