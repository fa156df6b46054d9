"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())


def duck_rows(con, sql):
    con.execute(sql)
    names = [d[0] for d in con.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(row[i] for i in order) for row in con.fetchall())
    return sorted(names), rows


def difference(spark_side, duck_side):
    """None if equal, else a short account of what differs."""
    (sc, sr), (dc, dr) = spark_side, duck_side
    if sc != dc:
        return f"columns {sc} != {dc}"
    if sr != dr:
        only_spark, only_duck = list((sr - dr).items())[:3], list((dr - sr).items())[:3]
        return f"rows {sum(sr.values())} != {sum(dr.values())}; only Spark {only_spark}; only DuckDB {only_duck}"
    return None
