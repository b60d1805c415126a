"""Compare a Spark result with a DuckDB result, regardless of row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    return v


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences, empty when the results agree."""
    relation = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} against {sorted(relation.columns)}"]
    out = []
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            out.append(f"type of {name}: {kind} against {kinds[name]}")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    ours = sorted((tuple(_plain(v) for v in r) for r in df.select(*columns).collect()), key=key)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted((tuple(_plain(v) for v in r) for r in relation.project(quoted).fetchall()), key=key)
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} against {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, e.g. {dict(zip(columns, zip(*bad[0])))}")
    return out
