"""Run queries next to their SQL in DuckDB and compare whole results.

    python -m ticketmill.catalog.check /path/to/tables [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import pandas as pd

from ticketmill.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return str(pd.Timestamp(v).tz_localize(None))
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    names = sorted(pdf.columns)
    columns = [[_plain(v) for v in pdf[c].astype(object)] for c in names]
    return sorted(zip(*columns), key=repr) if columns else []


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "array<bigint>": "BIGINT[]",
    "array<string>": "VARCHAR[]",
}


def compare(spark, con, sf: str, fn, sql: str) -> str:
    df = fn(spark, sf)
    types = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    odd = [f"{c} {t}/{types.get(c)}" for c, t in df.dtypes if SAME.get(t) != types.get(c)]
    if odd:
        return f"types {odd}"
    got = df.toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference\n   got  {repr(x)[-900:]}\n   want {repr(y)[-900:]}"
    return ""


def main(argv: list[str]) -> int:
    from ticketmill.catalog import ORACLES, QUERIES

    sf, prefixes = argv[0], tuple(argv[1:])
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem, kind = compare(spark, con, sf, fn, ORACLES[name]), "sql"
            else:
                n = fn(spark, sf).count()
                problem, kind = "", f"{n} rows"
        except Exception as e:  # noqa: BLE001 - report and go on to the next query
            problem, kind = f"{type(e).__name__}: {str(e)[:1500]}", "error"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name} [{kind}] {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
