"""Connected components by joins: no part of the graph meets on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import drop_saved, saved


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links that a task holds, one from every node to the smallest node it reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for every node that is not itself
    the smallest of its component. Links with a null end or equal ends change nothing.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest it knows, until the links no longer change; that takes about the logarithm of the
    longest path. Minima are merged before the shuffle and the joins are plain, so a node with very
    many links is split over tasks. Each round is written, so a lost executor repeats one round."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    known = saved(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u, v).distinct(),
        "links",
    )
    state = _digest(known)
    while True:
        both = known.unionByName(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "lowest")
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = saved(large, "large-star")
        lower = saved(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = (
            large.join(lower, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        now = saved(small, "links")
        for table in (known, lowest, large, lower):
            drop_saved(table)
        known, before, state = now, state, _digest(now)
        if state == before:
            return known.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
