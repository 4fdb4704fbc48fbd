"""Query registry. A query declares its output columns once; both the Spark result and the SQL
are cast to them, so the two sides can be compared value by value."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources import Tables

SPARK_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}
MODULES = ("problems", "claims", "kpi", "profit", "stock", "explore", "streams")

# The same casts as sources.tables, for the SQL side.
SQL_TABLES = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders),
l AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount,
  CAST(l_tax AS DECIMAL(18,2)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM lineitem),
c AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer),
s AS (SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier),
p AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part),
e AS (SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props,
  CAST(ts AS DATE) AS day FROM events)
"""


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        df = self.build(Tables(spark, path))
        return df.select(
            *[F.col(f"`{name}`").cast(SPARK_TYPES[kind]).alias(name) for name, kind in self.columns]
        )

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        head = f"WITH RECURSIVE {SQL_TABLES.strip()}"
        if body.upper().startswith("WITH "):
            body = f"{head}, {body[5:]}"
        else:
            body = f"{head} {body}"
        casts = ", ".join(f'CAST("{n}" AS {k}) AS "{n}"' for n, k in self.columns)
        return f"SELECT {casts} FROM ({body}) AS result"


REGISTRY: dict[str, Query] = {}


def query(columns: str, sql: str | None = None):
    """Register a function ``(tables) -> DataFrame`` under its own name."""
    parsed = tuple(tuple(part.split()) for part in columns.split(","))

    def register(build):
        if build.__name__ in REGISTRY:
            raise ValueError(f"query {build.__name__} is registered twice")
        REGISTRY[build.__name__] = Query(build.__name__, build, parsed, sql)
        return build

    return register


def ratio_sql(numerator: str, denominator: str, digits: int) -> str:
    """SQL for a non-negative integer ratio rounded half up, by integer arithmetic."""
    scale = 10**digits
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"CAST((2 * {n} * {scale} + {d}) // (2 * {d}) AS DOUBLE) / {scale}"


def _load() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tallyworks.plans.{module}")
    return REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, q in _load().items() if (sql := q.oracle()) is not None}
