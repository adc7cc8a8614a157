"""Side-by-side check of a registered Spark plan against its DuckDB SQL (rows, columns, values)."""

from __future__ import annotations

import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=9):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True), digits)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows_of(cols, records, digits=9):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None, digits: int = 9) -> dict:
    from alignfold.plans.registry import ORACLE, QUERIES

    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(s_rows), "cols": sorted(s_cols)}
    if name not in ORACLE:
        res["oracle"] = None
        return res
    con = con or duck(sf_dir)
    rel = con.sql(ORACLE[name])
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    res["types_match"] = s_types == d_types
    if not res["types_match"]:
        res["type_diff"] = {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types)
                            if s_types.get(k) != d_types.get(k)}
    cur = con.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res.update(oracle_rows=len(d_rows), oracle_cols=sorted(d_cols))
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    res["rows_match"] = len(s_rows) == len(d_rows)
    if res["cols_match"]:
        a, b = rows_of(s_cols, s_rows, digits), rows_of(d_cols, d_rows, digits)
        res["values_match"] = a == b
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            res["first_diff"] = repr(diff)[:1500]
    else:
        res["values_match"] = False
    return res
