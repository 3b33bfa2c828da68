"""Run queries against their check SQL and report differences: ``python -m catalog.verify [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from catalog import QUERIES, Tables
from catalog.engine import DRIVER_TABLES


def _plain(value: object) -> object:
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "date") and callable(value.date) and getattr(value, "hour", 0) == 0:
        return str(value)[:10]
    if isinstance(value, (bool, int, str)):
        return value
    return str(value)


def _key(row: tuple) -> tuple:
    return tuple(
        (0, 0.0, "") if v is None else (1, float(v), "") if isinstance(v, (bool, int, float)) else (2, 0.0, str(v))
        for v in row
    )


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def _kind(name: str) -> str:
    """Class of a type name of either engine."""
    name = name.lower()
    if name.startswith(("hugeint", "decimal", "uhugeint")):
        return name.split("(")[0]
    for kind, starts in (
        ("int", ("tinyint", "smallint", "int", "bigint", "number")), ("float", ("double", "float")),
        ("text", ("string", "varchar")), ("bool", ("bool",)), ("date", ("date",)), ("time", ("timestamp",)),
    ):
        if name.startswith(starts):
            return kind
    return name


def type_differences(df, connection: duckdb.DuckDBPyConnection, check: str) -> list[str]:
    """Columns whose types differ in kind between a query and its check SQL."""
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {check}").fetchall()}
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [
        f"{c}: {ours[c]} / {described[c]}" for c in sorted(ours)
        if c in described and _kind(ours[c]) != _kind(described[c]) and described[c] != '"NULL"'
    ]


def compare(tables: Tables, connection: duckdb.DuckDBPyConnection, name: str) -> tuple[str, int, float]:
    """Status, number of rows and seconds of one query."""
    q = QUERIES[name]
    start = time.time()
    df = q.build(tables)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if q.check is None:
        return "rows-only", len(got), seconds
    cursor = connection.execute(q.check)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(set(columns) ^ set(df.columns))}", len(got), seconds
    a, b = rows_of(df.columns, got), rows_of(columns, expected)
    if len(a) != len(b):
        return f"ROWS {len(a)} != {len(b)}", len(got), seconds
    names = sorted(columns)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if not bad:
        types = type_differences(df, connection, q.check)
        return (f"TYPES {types}" if types else "ok"), len(got), seconds
    x, y = bad[0]
    cells = [(n, p, q_) for n, p, q_ in zip(names, x, y, strict=True) if p != q_]
    return f"VALUES {len(bad)} rows, e.g. {cells[:4]}", len(got), seconds


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in DRIVER_TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return connection


def main(argv: list[str]) -> int:
    from metricmart.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = get_spark("verify", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name in names:
        if name.endswith("*"):
            names += [n for n in QUERIES if n.startswith(name[:-1])]
            continue
        try:
            status, rows, seconds = compare(Tables(spark, sf_dir), connection, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            status, rows, seconds = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0, 0.0
        if status not in ("ok", "rows-only"):
            failures += 1
        print(f"{name:40s} {rows:7d} rows {seconds:6.2f}s  {status}", flush=True)
    print(f"{failures} of {len(names)} failed")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
