"""Compare registered queries with their SQL."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


# Spark type -> type the check tool should give.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    got = _canonical(df.columns, df.collect())
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {df.columns} / {rel.columns}"
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    wrong = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema.fields
             if TYPES[f.dataType.simpleString()] != types[f.name]}
    if wrong:
        return f"types {wrong}"
    want = _canonical(rel.columns, rel.fetchall())
    if got != want:
        miss = next((p for p in zip(got, want) if p[0] != p[1]), None)
        return f"{len(got)} / {len(want)} rows, first difference {miss}"
    return None if got else "no rows"


if __name__ == "__main__":
    from pathlib import Path
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from eventloom.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        sql = e.oracle_sql().get(name)
        try:
            if sql:
                verdict = difference(spark, con, name, fn, sql, sf_dir) or "ok"
            else:
                verdict = f"rows {fn(spark, sf_dir).count()}"
        except Exception as err:  # report and go on with the next query
            verdict = f"ERROR {type(err).__name__} {str(err)[:600]}"
        print(f"{name:26s} {time.time() - t:6.2f}s {verdict}", flush=True)
