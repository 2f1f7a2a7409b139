"""Compare a Spark query with its DuckDB statement: same columns, same rows as multisets."""

from __future__ import annotations

import math
import os
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description of the first differences."""
    names, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    types = {n: {type(r[i]).__name__ for r in c if r[i] is not None} for c in (got,) for i, n in enumerate(names)}
    want_types = {n: {type(r[i]).__name__ for r in want if r[i] is not None} for i, n in enumerate(names)}
    if types != want_types:
        return "types " + str({n: (types[n], want_types[n]) for n in names if types[n] != want_types[n]})
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows vs {sum(want.values())}; {sum(extra.values())} only in Spark, e.g. "
            f"{list(extra)[:2]}; {sum(missing.values())} only in SQL, e.g. {list(missing)[:2]}"
        )
    return None
