"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and value != value:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, value)
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out)


def difference(spark, con, name, fn, sql, sf_dir):
    """None if both agree, else a message."""
    frame = fn(spark, sf_dir)
    got = frame.collect()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    kinds = {c[0]: str(c[1]) for c in result.description}
    for field in frame.schema:
        spark_kind = field.dataType.typeName()
        sql_kind = {"long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(spark_kind, spark_kind)
        if kinds[field.name] not in (sql_kind,):
            return f"type of {field.name}: {spark_kind} vs {kinds[field.name]}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = rows_of(frame.columns, got), rows_of(columns, want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(columns)}\n   spark {[v[1] for v in x]}\n   sql   {[v[1] for v in y]}"
    return None if got else "EMPTY"


if __name__ == "__main__":
    from skillgrid.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                message = None if fn(spark, sf_dir).count() else "EMPTY"
                message = message or None
                label = "rows-only"
            else:
                message, label = difference(spark, con, name, fn, sql, sf_dir), "ok"
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        if message:
            bad += 1
            print(f"FAIL {name} ({took:.1f}s): {message}", flush=True)
        else:
            print(f"{label} {name} {took:.1f}s", flush=True)
    print("failures:", bad)
