"""Compare a Spark result with DuckDB's answer to the query's SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SAME_TYPE = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    out = []
    for row in frame.itertuples(index=False, name=None):
        out.append(tuple(_plain(v) for v in row))
    return sorted(out, key=repr)


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
        return None
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        # An integer column with NULLs comes as floats from one side only.
        return int(v)
    return v


def difference(spark_df, con, sql: str) -> str | None:
    types = {d[0]: SAME_TYPE.get(str(d[1]), str(d[1])) for d in con.execute(sql).description}
    mine = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    if types != mine:
        return f"types {sorted(mine.items())} != {sorted(types.items())}"
    want = con.execute(sql).df()
    got = spark_df.toPandas()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return None
    extra = [x for x in a if x not in set(b)][:3]
    missing = [x for x in b if x not in set(a)][:3]
    return f"{len(a)} rows, want {len(b)}; only Spark {extra}; only SQL {missing}"
