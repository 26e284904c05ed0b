"""Spark results against the SQL of the same query, as the driver compares them."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 5)
    return str(value)


def rows(records: list[dict], names: list[str]) -> list[tuple]:
    return sorted((tuple(plain(r[n]) for n in names) for r in records), key=repr)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    con = duckdb.connect()
    for t in TABLES:
        if Path(sf_dir, f"{t}.parquet").exists():
            path = f"{sf_dir}/{t}.parquet" + ("/*.parquet" if Path(sf_dir, f"{t}.parquet").is_dir() else "")
            con.sql(f"create view {t} as select * from '{path}'")
    frame = query(spark, sf_dir)
    mine = [r.asDict() for r in frame.collect()]
    relation = con.sql(sql)
    theirs = [dict(zip(relation.columns, r, strict=True)) for r in relation.fetchall()]
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} and {sorted(relation.columns)}"
    names = sorted(frame.columns)
    a, b = rows(mine, names), rows(theirs, names)
    if a == b:
        return ""
    odd = [x for x in a if x not in b][:3], [x for x in b if x not in a][:3]
    return f"{len(a)} and {len(b)} rows; {odd}"
