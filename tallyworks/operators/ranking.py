"""Top rows, leaders and n-th values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.functions import season
from tallyworks.operators.ordering import order_columns, running_total


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key. Spark cuts each map task's rows of a key to ``n``
    before the shuffle, so a very large key sends only a few rows."""
    window = W.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n).drop("__rn")


def first_period_rows(df: DataFrame, key: str, period: str, name: str = "first_period") -> DataFrame:
    """All rows of each key's first period."""
    firsts = df.groupBy(key).agg(F.min(period).alias(period))
    return df.join(firsts, [key, period], "left_semi").withColumn(name, F.col(period))


def value_as_of(
    df: DataFrame,
    key: str,
    value: str,
    change_date: str,
    as_of,
    default,
    tie: str | None = None,
    name: str = "value",
) -> DataFrame:
    """Newest value of every key on a date; keys that had no value yet get the default."""
    order = F.struct(change_date, tie) if tie else F.col(change_date)
    known = F.col(change_date) <= F.lit(as_of)
    newest = F.max_by(F.col(value), F.when(known, order))
    return df.groupBy(key).agg(F.coalesce(newest, F.lit(default)).alias(name))


def last_within_cap(
    df: DataFrame, order: Sequence[str], amount: str, cap, total: str = "running_total", **options
) -> DataFrame:
    """The last row whose running total is within the cap."""
    totals = running_total(df, order, amount, total, **options)
    backwards = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    return totals.filter(F.col(total) <= F.lit(cap)).orderBy(*order_columns(backwards)).limit(1)


def leader(df: DataFrame, label: str, score: str, name: str = "results") -> DataFrame:
    """Label of the row with the highest score; the smaller label wins a tie."""
    return df.orderBy(F.desc(score), F.asc(label)).limit(1).select(F.col(label).alias(name))


def leaders_union(boards: Sequence[tuple[DataFrame, str, str]], name: str = "results") -> DataFrame:
    """Winners of several leaderboards (frame, label, score), stacked."""
    out = None
    for frame, label, score in boards:
        winner = leader(frame, label, score, name)
        out = winner if out is None else out.unionByName(winner)
    return out


def nth_distinct(df: DataFrame, value: str, n: int, name: str = "nth_value") -> DataFrame:
    """The n-th highest distinct value in one row, NULL when there are fewer values."""
    top = (
        df.select(value)
        .filter(F.col(value).isNotNull())
        .distinct()
        .orderBy(F.desc(value))
        .limit(n)
    )
    return top.agg(F.when(F.count(value) == n, F.min(value)).alias(name))


def top_n_dense(
    df: DataFrame, group: str, value: str, n: int, name: str = "dense_rank"
) -> DataFrame:
    """Rows with one of the ``n`` highest distinct values of their group, ties kept. Only the
    distinct values are ranked; the rows are found by an equi join on (group, value)."""
    window = W.partitionBy(group).orderBy(F.desc(value))
    best = (
        df.select(group, value)
        .filter(F.col(value).isNotNull())
        .distinct()
        .withColumn(name, F.row_number().over(window))
        .filter(F.col(name) <= n)
    )
    return df.join(best, [group, value])


def season_leader(
    df: DataFrame,
    date: str,
    category: str,
    quantity: str,
    revenue: Column,
) -> DataFrame:
    """Category with the largest quantity per season; ties go to the larger revenue, then to the
    smaller name."""
    per_category = (
        df.withColumn("season", season(F.col(date)))
        .filter(F.col("season").isNotNull())
        .groupBy("season", category)
        .agg(F.sum(quantity).alias("total_quantity"), F.sum(revenue).alias("total_revenue"))
    )
    order = ["-total_quantity", "-total_revenue", category]
    return first_rows(per_category, ["season"], order).orderBy("season")
