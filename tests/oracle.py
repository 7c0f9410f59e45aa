"""Local stand-in for the driver's oracle check: run a catalog query in Spark
and its SQL in DuckDB on the same parquet files, compare rows exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from marketlens.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def spark_family(t) -> str:
    from pyspark.sql import types as T
    if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
        return "int32"
    if isinstance(t, T.LongType):
        return "int64"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "float"
    if isinstance(t, T.DecimalType):
        return "decimal"
    if isinstance(t, T.StringType):
        return "string"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, T.DateType):
        return "date"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return t.simpleString()


def duck_family(t: str) -> str:
    t = t.upper()
    if t in ("INTEGER", "SMALLINT", "TINYINT"):
        return "int32"
    if t in ("BIGINT",):
        return "int64"
    if t in ("HUGEINT",):
        return "int128"
    if t in ("DOUBLE", "FLOAT"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t == "VARCHAR":
        return "string"
    if t == "BOOLEAN":
        return "bool"
    if t == "DATE":
        return "date"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return t


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, con, sf_dir: str, entry) -> dict:
    sdf = entry.fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    rel = con.sql(entry.sql)
    dcols = rel.columns
    out = {"name": entry.name, "spark_rows": len(srows)}
    if sorted(dcols) != cols:
        out.update(ok=False, why=f"columns differ: spark={cols} sql={sorted(dcols)}")
        return out
    idx = [dcols.index(c) for c in cols]
    sf = {f.name: spark_family(f.dataType) for f in sdf.schema.fields}
    df_ = {c: duck_family(str(t)) for c, t in zip(dcols, rel.types)}
    out["type_diff"] = {c: (sf[c], df_[c]) for c in cols if sf[c] != df_[c]}
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    out["sql_rows"] = len(drows)
    srows.sort(key=_key)
    drows.sort(key=_key)
    if len(srows) != len(drows):
        out.update(ok=False, why="row count")
        return out
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    out.update(ok=not bad, mismatches=len(bad), sample=bad[:2])
    return out
