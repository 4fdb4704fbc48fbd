"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """CSV with a header and a declared schema. A malformed row stops the job."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.options(**options).csv(path)


def read_partition(spark: SparkSession, path: str, column: str, value, schema: str | None = None) -> DataFrame:
    """Rows of one partition value, for example one business date."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).filter(F.col(column) == F.lit(value))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """Table of a remote database. Spark sends filters and the column list along; with a split
    column the table is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("pushDownPredicate", "true").options(**properties)
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def xml_rows(
    df: DataFrame, column: str, row_tag: str, attributes: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows written as XML elements with attributes, read from a text column.

    ``attributes`` is a DDL list such as ``"Id int, Quantity decimal(15,4)"``; the columns keep
    these names. Rows whose ``IsTick`` attribute is 0 are left out.
    """
    fields = [part.strip().split(" ", 1) for part in _ddl_parts(attributes)]
    schema = ", ".join(f"_{name}: {kind}" for name, kind in fields)
    element = F.from_xml(F.col(column), f"{row_tag} array<struct<{schema}>>").getField(row_tag)
    exploded = df.select(*keep, F.explode(element).alias("__e"))
    out = exploded.select(*keep, *[F.col(f"__e._{name}").alias(name) for name, _ in fields])
    if "IsTick" in out.columns:
        out = out.filter(F.coalesce(F.col("IsTick"), F.lit(1)) != 0)
    return out


def _ddl_parts(ddl: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [*parts, current]
