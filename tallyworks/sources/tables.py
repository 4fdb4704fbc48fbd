"""The star-schema tables, with money as decimals and days as dates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import MONEY

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}
MONEY_COLUMNS = {
    "customer": ["c_acctbal"],
    "supplier": ["s_acctbal"],
    "part": ["p_retailprice"],
    "orders": ["o_totalprice"],
    "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "events": ["value"],
}
DATE_COLUMNS = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}


class Tables:
    """Lazy readers. Casts sit in a projection over the scan, so column pruning and date
    filters still reach the Parquet reader."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self, name: str) -> DataFrame:
        df = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")
        casts = {c: F.col(c).cast(MONEY) for c in MONEY_COLUMNS.get(name, [])}
        casts |= {c: F.col(c).cast("date") for c in DATE_COLUMNS.get(name, [])}
        return df.withColumns(casts) if casts else df

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events").withColumn("day", F.to_date("ts"))
