"""Order-dependent questions about the rows of an entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.operators.ordering import order_columns, ordered_scan


def first_last_improved(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    tie: str | None = None,
    names: Sequence[str] = ("first_value", "latest_value"),
) -> DataFrame:
    """Keys whose last value is above their first, with rows on at least two dates."""
    position = F.struct(date, tie) if tie else F.col(date)
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(value, position).alias(names[0]),
            F.max_by(value, position).alias(names[1]),
            F.min(date).alias("__from"),
            F.max(date).alias("__to"),
        )
        .filter((F.col("__from") < F.col("__to")) & (F.col(names[1]) > F.col(names[0])))
        .drop("__from", "__to")
    )


def last_n_increasing(
    df: DataFrame, entity: str, order: Sequence[str], value: str, n: int = 3, name: str = "gain"
) -> DataFrame:
    """Entities whose last ``n`` values rise strictly, with the total gain. Each map task keeps
    only its last ``n`` rows of an entity, so what reaches the window is small."""
    backwards = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    window = W.partitionBy(entity).orderBy(*order_columns(backwards))
    last = (
        df.select(entity, *[c.lstrip("-") for c in order], value)
        .withColumn("__rn", F.row_number().over(window))
        .filter(F.col("__rn") <= n)
        .withColumn("__before", F.lead(value).over(window))
    )
    rises = (F.col("__rn") == n) | (F.col(value) > F.col("__before"))
    return (
        last.groupBy(entity)
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.bool_and(F.coalesce(rises, F.lit(False))).alias("__rising"),
            (
                F.max(F.when(F.col("__rn") == 1, F.col(value)))
                - F.max(F.when(F.col("__rn") == n, F.col(value)))
            ).alias(name),
        )
        .filter((F.col("__rows") == n) & F.col("__rising"))
        .select(entity, name)
    )


def recovery_time(
    df: DataFrame, entity: str, date: str, state: str, first: str, then: str, name: str = "days"
) -> DataFrame:
    """Days from an entity's first row in one state to its first later row in another. Both
    sides are reduced to one row per entity and date before they meet."""
    began = (
        df.filter(F.col(state) == first).groupBy(entity).agg(F.min(date).alias("__from"))
    )
    later = df.filter(F.col(state) == then).select(entity, F.col(date).alias("__to")).distinct()
    return (
        later.join(began, entity)
        .filter(F.col("__to") > F.col("__from"))
        .groupBy(entity)
        .agg(F.min(F.datediff("__to", "__from")).alias(name))
    )


def cyclic_sequence(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    date: str,
    member: str,
    amount: str,
    min_members: int = 3,
    min_cycles: int = 2,
    max_gap: int = 2,
    **options,
) -> DataFrame:
    """Entities that go through one cycle of ``k`` members over and over. With ``k`` the number of
    distinct members, the sequence is such a cycle exactly when all rows with the same position
    modulo ``k`` have the same member."""
    sizes = df.groupBy(entity).agg(
        F.countDistinct(member).alias("__k"),
        F.count(F.lit(1)).alias("__rows"),
        F.sum(amount).alias("__amount"),
    )
    able = sizes.filter(
        (F.col("__k") >= min_members) & (F.col("__rows") >= F.col("__k") * min_cycles)
    )
    placed = ordered_scan(
        df.select(entity, member, date, *[o for o in order if o != date]).join(
            able.select(entity), entity, "left_semi"
        ),
        order,
        [entity],
        number="__pos",
        previous={"__last": date},
        **options,
    )
    # Grouping on a struct keeps the group-by from reusing the join's partitioning, so that
    # Spark may split the join for a very large entity.
    residue = F.struct(F.col(entity).alias("e"), (F.col("__pos") % F.col("__k")).alias("r"))
    by_residue = (
        placed.join(able.select(entity, "__k"), entity)
        .select(residue.alias("__slot"), member, F.datediff(date, "__last").alias("__gap"))
        .groupBy("__slot")
        .agg(
            (F.min(member) == F.max(member)).alias("__same"),
            F.max("__gap").alias("__gap"),
        )
    )
    cyclic = (
        by_residue.groupBy(F.col("__slot.e").alias(entity))
        .agg(F.bool_and("__same").alias("__same"), F.max("__gap").alias("__gap"))
        .filter(F.col("__same") & (F.col("__gap") <= max_gap))
    )
    return able.join(cyclic.select(entity), entity, "left_semi").select(
        entity, F.col("__k").alias("cycle_length"), F.col("__amount").alias("total_amount")
    )


def transition_counts(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    item: str,
    rating: str | None = None,
    min_rows: int = 1,
    min_average=None,
    names: Sequence[str] = ("first_item", "second_item", "transition_count"),
    **options,
) -> DataFrame:
    """How often one item directly follows another, among entities with enough rows and a high
    enough mean rating."""
    mean_ok = F.lit(True)
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    if rating is not None and min_average is not None:
        aggregates.append(F.avg(F.col(rating)).alias("__avg"))
        mean_ok = F.col("__avg") >= F.lit(min_average)
    qualified = df.groupBy(entity).agg(*aggregates).filter((F.col("__rows") >= min_rows) & mean_ok)
    rows = df.select(entity, item, *[o for o in order if o not in (entity, item)])
    moves = ordered_scan(
        rows.join(qualified.select(entity), entity, "left_semi"),
        order,
        [entity],
        following={"__next": item},
        **options,
    )
    return (
        moves.filter(F.col("__next").isNotNull())
        .groupBy(F.col(item).alias(names[0]), F.col("__next").alias(names[1]))
        .agg(F.count(F.lit(1)).alias(names[2]))
    )


def consecutive_runs(
    df: DataFrame, id: str, predicate: Column, k: int = 3, **options
) -> DataFrame:
    """Rows in runs of at least ``k`` consecutive ids that all meet a test. Ids are unique."""
    numbered = ordered_scan(df.filter(predicate), [id], number="__n", **options)
    marked = numbered.withColumn("__run", F.col(id) - F.col("__n"))
    long_runs = (
        marked.groupBy("__run").agg(F.count(F.lit(1)).alias("__len")).filter(F.col("__len") >= k)
    )
    return marked.join(long_runs, "__run", "left_semi").drop("__run", "__n")
