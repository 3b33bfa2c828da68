"""How queries, their check SQL and the bound tables fit together.

A *bound table* is a driver table brought into the shape of a warehouse table (a fact, a dimension, a staging table) by
one SQL text that Spark and the check engine both understand. A query gets the bound tables it names and runs the
library on them; its check SQL states the expected result over the same bound tables.
"""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricmart.session import apply_settings, shared_dir
from metricmart.sources.sinks import Stage

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

BOUND: dict[str, str] = {}
SHARED: set[str] = set()
ROLLUPS: dict[str, dict[str, str]] = {}


def bind(name: str, sql: str, shared: bool = False, rollups: Mapping[str, str] | None = None) -> None:
    """Register a bound table.

    A ``shared`` one feeds several tables of the same query. It reduces a large join to few rows, so each query stores
    it once in the cluster's shared folder instead of running the join once per reader. ``rollups`` names finer shared
    tables and the SQL that gives the same rows from each: a query that has stored one does not run the join again.
    """
    BOUND[name] = sql
    if shared:
        SHARED.add(name)
    if rollups:
        ROLLUPS[name] = dict(rollups)


def _mentions(sql: str) -> list[str]:
    """Tables a SQL text reads, in order of appearance."""
    names = re.findall(r"(?i)\b(?:from|join)\s+\(?\s*([a-z_][a-z0-9_]*)", sql)
    known = [n for n in names if n in BOUND or n in DRIVER_TABLES]
    return list(dict.fromkeys(known))


class Tables(Mapping[str, DataFrame]):
    """Driver and bound tables by name, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = apply_settings(spark), sf_dir
        self._built: dict[str, DataFrame] = {}
        self._run = f"query-{uuid.uuid4().hex}"
        self.folder = f"{shared_dir(spark)}/metricmart/{self._run}"
        self._written = False

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        rollups = [sql for finer, sql in ROLLUPS.get(name, {}).items() if finer in self._built]
        df = self.sql(rollups[0] if rollups else BOUND[name])
        return self.store(name, df) if name in SHARED else df

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table to the shared folder and read it back, with exact statistics and no lineage."""
        return Stage(self.spark, self.shared(), self._run).write(name, df)

    def shared(self) -> str:
        """The shared folder. What a query writes below ``folder`` goes when the driver's process ends."""
        if not self._written:
            self._written = True
            atexit.register(self._close)
        return self.folder.rsplit("/", 1)[0]

    def file(self, name: str) -> str:
        """A path below this query's folder."""
        self.shared()
        return f"{self.folder}/{name}"

    def _close(self) -> None:
        try:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # noqa: BLE001 - the session has ended; its cluster's folder is cleaned with it
            pass

    def sql(self, text: str) -> DataFrame:
        """A SQL text over driver and bound tables."""
        names = _mentions(text)
        template = text.replace("{", "{{").replace("}", "}}")
        for name in names:
            template = re.sub(rf"(?i)\b(from|join)(\s+\(?\s*){name}\b", rf"\1\2{{{name}}}", template)
        return self.spark.sql(template, **{n: self[n] for n in names})

    def __iter__(self) -> Iterator[str]:
        return iter([*DRIVER_TABLES, *BOUND])

    def __len__(self) -> int:
        return len(DRIVER_TABLES) + len(BOUND)


def _with_clauses(sql: str) -> str:
    """Put the bound tables a SQL text needs in front of it, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _mentions(text):
            if name in BOUND and name not in order:
                visit(BOUND[name])
                order.append(name)

    visit(sql)
    clauses = [f"{name} AS ({BOUND[name]})" for name in order]
    body = sql.strip()
    if body[:5].lower() == "with ":
        clauses.append(body[5:])
        return "WITH " + ",\n".join(clauses)
    return ("WITH " + ",\n".join(clauses) + "\n" if clauses else "") + body


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    check: str | None
    operators: Sequence[str]


QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, check: str | None = None, **rounding: int | Sequence[str]):
    """Register a query. ``rounding`` maps ``d6=[columns]`` to six digits on both sides, for values whose last digits
    depend on the order of a floating-point sum. Adding zero turns a negative zero into a plain one."""
    digits = {c: int(k[1:]) for k, columns in rounding.items() for c in columns}

    def wrap(build: Callable[[Tables], DataFrame]):
        def rounded(tables: Tables) -> DataFrame:
            df = build(tables)
            return df.withColumns({c: F.round(F.col(c), n) + F.lit(0.0) for c, n in digits.items()}) if digits else df

        sql = None
        if check is not None:
            text = check
            if digits:
                parts = ", ".join(f"round({c}, {n}) + 0.0 AS {c}" for c, n in digits.items())
                text = f"SELECT * REPLACE ({parts}) FROM ({_with_clauses(check)}) AS checked"
                sql = text
            else:
                sql = _with_clauses(check)
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, rounded, sql, operators.split())
        return build

    return wrap


def case(column: str, mapping: Mapping[object, object], other: str = "NULL") -> str:
    """CASE text from a mapping; text values are quoted."""

    def literal(value: object) -> str:
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)

    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {other} END"


def cents(column: str) -> str:
    """A money or quantity column as whole hundredths. Integer sums are exact in any order, and far cheaper than
    decimal sums."""
    return f"CAST(FLOOR({column} * 100 + 0.5) AS BIGINT)"


def total(column: str, where: str | None = None) -> str:
    """Exact sum as a double."""
    value = cents(column) if where is None else f"CASE WHEN {where} THEN {cents(column)} ELSE 0 END"
    return f"CAST(SUM({value}) AS DOUBLE) / 100"


YEAR = "CAST(year(o_orderdate) AS INT)"
QUARTER = "CAST(quarter(o_orderdate) AS INT)"
