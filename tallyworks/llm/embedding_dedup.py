"""Embedding near-duplicates: a pivot-permutation index, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.common import saved
from tallyworks.llm.components import connected_components, forest

THRESHOLD = 0.95
#: Reference points, and the sample they are picked from so that they lie far apart.
PIVOTS = 256
SAMPLE = 2_048
#: No two pivots have a larger cosine: near copies rank pivots alike only where those are far apart.
APART = 0.7
#: Nearest pivots that describe a vector, and how many of them a pair must share.
NEAREST = 6
SHARED = 2
#: Members of a list that are compared at a time; longer lists are cut into tiles of two blocks.
BLOCK = 2_048
#: Rows of the product matrix that is held at a time.
STEP = 256


def spread_pivots(vectors: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Farthest-first choice of unit vectors: near copies give one pivot, not many."""
    chosen, nearest = [0], vectors @ vectors[0]
    while len(chosen) < min(count, len(vectors)):
        far = int(np.argmin(nearest))
        if nearest[far] > APART:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    return vectors[chosen]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one; scaled by the largest part first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, values[starts[rows][:, None] + np.arange(size)]


def usable(vector) -> F.Column:
    """Not null, no null or non-finite part, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def list_entries(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int, shared: int) -> DataFrame:
    """One row for each vector and list it is in. A list belongs to ``shared`` pivots; a vector is in
    those of all such choices among its nearest pivots, so vectors that share as many pivots share
    a list. ``tops`` are its pivots by number."""
    kind = classes.schema["vector"].dataType.elementType.simpleString()
    schema = f"dim int, list array<int>, rep long, size long, tops array<int>, vector array<{kind}>"
    arrow = pa.float32() if kind == "float" else pa.float64()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, size, column = batch.columns
            for dim, rows, matrix in by_length(column):
                reference = pivots.get(dim)
                if reference is None or len(reference) < nearest:
                    tops = np.full((len(rows), shared), -1)
                else:
                    near = unit(matrix) @ reference.T
                    tops = np.sort(np.argsort(-near, axis=1, kind="stable")[:, :nearest], axis=1)
                taken = pa.array(rows)
                for choice in combinations(range(tops.shape[1]), shared):
                    keys = tops[:, list(choice)].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), dim, np.int32)),
                            _lists(keys),
                            rep.take(taken),
                            size.take(taken),
                            _lists(tops.astype(np.int32)),
                            column.take(taken).cast(pa.list_(arrow)),
                        ],
                        names=["dim", "list", "rep", "size", "tops", "vector"],
                    )

    return classes.select("rep", "size", "vector").mapInArrow(describe, schema)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def tiles(entries: DataFrame, block: int) -> DataFrame:
    """Entries with the tile they are compared in: ``i``, ``j`` and which of both blocks they are in.
    A list of up to ``block`` members is one tile; a longer one is dealt to blocks by the id, and
    each pair of blocks is a tile of its own, so no task gets a whole long list."""
    key = ["dim", "list"]
    long_lists = saved(
        entries.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > block)
        .select(*key, F.ceil(F.col("n") / block).cast("int").alias("blocks")),
        "long-lists",
    )
    dealt = entries.join(long_lists, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("*", other)
    return dealt.select(
        *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "size", "tops", "vector"
    )


def linked(tiled: DataFrame, threshold: float, shared: int) -> DataFrame:
    """Verified links: rows (a, null, n) that give vector ``a`` ``n`` more links, and rows (a, b, 0)
    that make a forest of the links of a task. A pair is verified in one list only, that of the
    first pivots it shares."""
    key = ["dim", "list", "i", "j"]
    sorted_rows = tiled.repartition(*key).sortWithinPartitions(*key, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            out = _compare(tile, threshold, shared)
            if out is not None:
                yield out

    return sorted_rows.mapInArrow(compare, "a long, b long, n long")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one tile; at most two blocks are held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(1)
        width = len(lists.flatten()) // batch.num_rows
        keys = np.column_stack(
            [batch.column(0).to_numpy(), lists.flatten().to_numpy().reshape(-1, width), batch.column(2).to_numpy(), batch.column(3).to_numpy()]
        )
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if last is not None and not np.array_equal(last, keys[low]):
                if sum(map(len, held)) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = keys[low]
    if sum(map(len, held)) > 1:
        yield pa.Table.from_batches(held)


def _compare(tile: pa.Table, threshold: float, shared: int) -> pa.RecordBatch | None:
    tile = tile.combine_chunks()
    first = lambda name: tile.column(name).chunk(0)
    i, j, own, rep, size = (first(c).to_numpy() for c in ("i", "j", "own", "rep", "size"))
    n = tile.num_rows
    key = np.array(first("list")[0].as_py())
    tops = first("tops").flatten().to_numpy().reshape(n, -1)
    vectors = unit(first("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1))
    same = i[0] == j[0]
    left = np.arange(n) if same else np.flatnonzero(own == i[0])
    right = left if same else np.flatnonzero(own == j[0])
    more = np.zeros(n, np.int64)
    found_a, found_b = [], []
    for low in range(0, len(left), STEP):
        rows = left[low : low + STEP]
        a, b = np.nonzero(vectors[rows] @ vectors[right].T >= threshold)
        a, b = rows[a], right[b]
        if same:
            a, b = a[a < b], b[a < b]
        if key[0] >= 0 and len(a):
            # The lowest pivots that both have: those of this list, or the pair is verified there.
            common = (tops[a][:, :, None] == tops[b][:, None, :]).any(axis=2)
            rank = np.cumsum(common, axis=1)
            lowest = common & (rank <= shared)
            mine = (np.where(lowest, tops[a], 0).sum(axis=1) == key.sum()) & (
                np.where(lowest & np.isin(tops[a], key), 1, 0).sum(axis=1) == shared
            )
            a, b = a[mine], b[mine]
        np.add.at(more, a, size[b])
        np.add.at(more, b, size[a])
        found_a.append(a)
        found_b.append(b)
    a, b = np.concatenate(found_a or [left[:0]]), np.concatenate(found_b or [left[:0]])
    if not len(a):
        return None
    u, v = forest(rep[a], rep[b])
    has = np.flatnonzero(more)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([rep[has], u])),
            pa.array(np.concatenate([np.zeros(len(has), np.int64), v]), mask=np.arange(len(has) + len(u)) < len(has)),
            pa.array(np.concatenate([more[has], np.zeros(len(u), np.int64)])),
        ],
        names=["a", "b", "n"],
    )


def embedding_near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors with a cosine of at least ``threshold``),
    component_id (the smallest vec_id that links reach) and kept (vec_id is that one).

    Pivots come from a sample of at most ``SAMPLE`` vectors; every vector is indexed under its
    ``nearest`` pivots. Two vectors are candidates if they share ``shared`` of them; candidates are
    verified with double precision, so no link is false, and links of close pairs are missed only
    where the pivots differ. Equal vectors are one class with a size and are not paired.

    Null and zero vectors and those with null or non-finite parts link with nothing and are kept;
    so are vectors of another length than their partners. Different vectors under one vec_id are one
    node and share their links; rows with a null vec_id take the links of an equal vector with an id. An empty table gives no rows."""
    kind = vectors.schema[vector_col].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        vectors = vectors.withColumn(vector_col, F.col(f"`{vector_col}`").cast("array<double>"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    good = rows.filter(usable(F.col("vector")))
    classes = saved(
        good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")).filter("rep is not null"),
        "vector-classes",
    )
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()
    known: dict[int, list] = {}
    for row in sample:
        known.setdefault(len(row[0]), []).append(row[0])
    reference = {dim: spread_pivots(unit(np.array(v, np.float64)), pivots) for dim, v in known.items()}
    entries = saved(list_entries(classes, reference, nearest, shared), "pivot-lists")
    found = saved(linked(tiles(entries, block), threshold, shared), "vector-links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    parts = connected_components(found.filter(F.col("b").isNotNull()), "a", "b")
    result = saved(
        classes.join(counts, F.col("rep") == F.col("a"), "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("__vector"),
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "vector-components",
    )
    joined = good.join(result, F.col("vector") == F.col("__vector"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    alone = rows.filter(~usable(F.col("vector"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
