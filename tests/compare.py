"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return "-"
    if hasattr(v, "isoformat"):
        text = v.isoformat()
        return text if "T" in text else text + "T00:00:00"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows(names: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return sorted(names), rows(names, rel.fetchall())
