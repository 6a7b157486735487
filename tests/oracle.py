"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if not Path(f"{sf_dir}/{name}.parquet").exists():
            continue
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return tuple(map(_plain, value)) if isinstance(value, list) else value


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def difference(expected, actual) -> str | None:
    if expected[0] != actual[0]:
        return f"columns: SQL {expected[0]}, Spark {actual[0]}"
    missing, extra = expected[1] - actual[1], actual[1] - expected[1]
    if not missing and not extra:
        return None
    return (f"{sum(expected[1].values())} rows expected, {sum(actual[1].values())} found; "
            f"missing {list(missing)[:3]}, unexpected {list(extra)[:3]}")
