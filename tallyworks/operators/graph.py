"""Edges, parents, pairs and neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Categories of an entity that are paired with as many others at a time.
PAIR_BLOCK = 1_000


def category_pairs(
    df: DataFrame,
    entity: str,
    category: str,
    min_entities: int = 3,
    names: Sequence[str] = ("category1", "category2", "entity_count"),
    block: int = PAIR_BLOCK,
) -> DataFrame:
    """Category pairs that share at least ``min_entities`` entities. A category with fewer
    entities is in no such pair and is dropped first. The categories of an entity are dealt to
    blocks of about ``block`` and paired one pair of blocks at a time, so an entity with very many
    categories is spread over tasks; counts are added up in the tasks first."""
    first, second, count = names
    held = df.select(entity, category).filter(F.col(category).isNotNull() & F.col(entity).isNotNull()).distinct()
    common = (
        held.groupBy(category)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= min_entities)
    )
    kept = held.join(common.select(category), category, "left_semi")
    sizes = kept.groupBy(entity).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__blocks"))
    own = F.pmod(F.xxhash64(category), F.col("__blocks")).cast("int")
    dealt = kept.join(sizes, entity).withColumn("__own", own)
    tiles = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).select(
        entity, category, "__own", F.least("__own", "__other").alias("__i"), F.greatest("__own", "__other").alias("__j")
    )
    left = tiles.filter(F.col("__own") == F.col("__i")).select(entity, "__i", "__j", F.col(category).alias("__a"))
    right = tiles.filter(F.col("__own") == F.col("__j")).select(entity, "__i", "__j", F.col(category).alias("__b"))
    pairs = left.join(right, [entity, "__i", "__j"]).filter(
        (F.col("__i") < F.col("__j")) | (F.col("__a") < F.col("__b"))
    )
    return (
        pairs.groupBy(F.least("__a", "__b").alias(first), F.greatest("__a", "__b").alias(second))
        .agg(F.count(F.lit(1)).alias(count))
        .filter(F.col(count) >= min_entities)
    )


def fan_in_at_least(
    nodes: DataFrame, id: str, children: DataFrame, parent: str, k: int, name: str = "child_count"
) -> DataFrame:
    """Nodes with at least ``k`` children."""
    counts = (
        children.filter(F.col(parent).isNotNull())
        .groupBy(F.col(parent).alias(id))
        .agg(F.count(F.lit(1)).alias(name))
        .filter(F.col(name) >= k)
    )
    return nodes.join(counts, id)


def degrees(edges: DataFrame, a: str, b: str, node: str = "id", name: str = "num") -> DataFrame:
    # One pass over the edges: a union of both ends would make them twice.
    ends = edges.select(F.explode(F.array(a, b)).alias(node))
    return ends.groupBy(node).agg(F.count(F.lit(1)).alias(name))


def top_degree(
    edges: DataFrame, a: str, b: str, ties: bool = True, node: str = "id", name: str = "num"
) -> DataFrame:
    """The node with the most edges; with ``ties`` all nodes that share the highest degree,
    without it the smallest of them."""
    counted = degrees(edges, a, b, node, name)
    if not ties:
        return counted.orderBy(F.desc(name), F.asc(node)).limit(1)
    return counted.filter(F.col(name) == counted.agg(F.max(name)).scalar())


def tree_node_type(df: DataFrame, id: str, parent: str, name: str = "type") -> DataFrame:
    """Root, inner or leaf."""
    parents = (
        df.filter(F.col(parent).isNotNull())
        .select(F.col(parent).alias("__p"))
        .distinct()
    )
    label = (
        F.when(F.col(parent).isNull(), "Root")
        .when(F.col("__p").isNotNull(), "Inner")
        .otherwise("Leaf")
    )
    return df.join(parents, F.col(id) == F.col("__p"), "left").withColumn(name, label).drop("__p")


def swap_neighbours(df: DataFrame, id: str) -> DataFrame:
    """Exchange each odd id with the next one; an odd last id keeps its place."""
    last = df.agg(F.max(id)).scalar()
    moved = (
        F.when((F.col(id) % 2 == 1) & (F.col(id) == last), F.col(id))
        .when(F.col(id) % 2 == 1, F.col(id) + 1)
        .otherwise(F.col(id) - 1)
    )
    return df.withColumn(id, moved)
