"""SimHash near-duplicates: fingerprints compared by bit planes and carry-save counters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import fresh_names, saved, texts_of
from tallyworks.llm.components import connected_components, forest

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Bits of a piece. A fingerprint is keyed by each choice of all but ``RADIUS`` of its 8 pieces: two
#: within the radius agree in one choice at least, and a key has at most 2^16 fingerprints.
PIECE = 8
#: Hashes that are unpacked to bits at a time.
CHUNK = 1 << 17
LANES = 64
ALL = np.uint64(2**64 - 1)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def choices(radius: int) -> list[tuple[tuple[int, ...], int]]:
    """The free pieces of each key and the mask of the others."""
    found = []
    for free in combinations(range(64 // PIECE), radius):
        mask = (1 << 64) - 1
        for piece in free:
            mask &= ~(((1 << PIECE) - 1) << (PIECE * piece))
        found.append((free, mask))
    return found


def shingle_values(text: str, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), seed)]
    return [digest(b" ".join(run), seed) for run in zip(*(words[i:] for i in range(size)))]


def majority(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each slice of hashes the word whose bits are set in more than half of it."""
    counts = np.zeros((len(starts), 64), np.int64)
    for low in range(0, len(values), CHUNK):
        high = min(len(values), low + CHUNK)
        bits = np.unpackbits(values[low:high].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        rows = np.arange(first, last)
        rows = rows[ends[rows] > starts[rows]]
        if len(rows):
            counts[rows] += np.add.reduceat(bits, np.maximum(starts[rows], low) - low, axis=0, dtype=np.int64)
    over = 2 * counts > (ends - starts)[:, None]
    return np.packbits(over, axis=1).view(">u8").astype(np.uint64).ravel()


def with_fingerprints(texts: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The columns of ``texts`` but for the last one, the text, and fp (its 64 bits as a signed long);
    no words: zero."""
    kept = texts.columns[:-1]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                values, ends = [], []
                for text in part.column(len(kept)).to_pylist():
                    values += shingle_values(text, size, seed)
                    ends.append(len(values))
                stops = np.array(ends)
                fp = majority(np.array(values, np.uint64), np.concatenate([[0], stops[:-1]]), stops)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fp.view(np.int64))], names=[*kept, "fp"])

    return texts.mapInArrow(hashes, texts.select(*kept, F.lit(0).cast("long").alias("fp")).schema)


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every row; null texts are empty."""
    return with_fingerprints(texts_of(docs, id_col, text_col), size, seed)


def close_pairs(fp: np.ndarray, starts: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs, smaller first, within the radius inside runs of fingerprints that
    share a key. ``planes`` are the bit numbers in which the members of each run can differ.

    A block holds 64 members of a run as one machine word for each bit. A fingerprint is compared
    with a block by adding the differing bits into counters of one word each, for all 64 at once;
    it leaves a block as soon as every member is beyond the radius."""
    ends = np.append(starts[1:], len(fp))
    sizes = ends - starts
    keep = np.flatnonzero(sizes > 1)
    found_a, found_b = [], []
    starts, sizes, planes = starts[keep], sizes[keep], planes[keep]
    for block in range(int(-(-sizes.max() // LANES)) if len(sizes) else 0):
        runs = np.flatnonzero(sizes > block * LANES)
        low = starts[runs] + block * LANES
        lanes = np.minimum(sizes[runs] - block * LANES, LANES)
        # Members of the block, as positions; each run's come together.
        first = np.cumsum(lanes) - lanes
        lane = np.arange(lanes.sum()) - np.repeat(first, lanes)
        member = np.repeat(low, lanes) + lane
        run_of = np.repeat(np.arange(len(runs)), lanes)
        # Each fingerprint of a run meets the block's members that come after it.
        n = lanes + block * LANES
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run = np.repeat(np.arange(len(runs)), n)
        query = starts[runs][run] + offset
        ahead = np.clip(offset - block * LANES + 1, 0, LANES)
        width = lanes[run]
        beyond = ~((ALL >> (LANES - width).astype(np.uint64)) & np.where(ahead < LANES, ALL << np.minimum(ahead, 63).astype(np.uint64), np.uint64(0)))
        counters = [np.zeros(len(query), np.uint64) for _ in range(max(1, radius.bit_length()))]
        for p in range(planes.shape[1]):
            bit = planes[runs, p].astype(np.uint64)
            words = np.bitwise_or.reduceat(((fp[member] >> bit[run_of]) & np.uint64(1)) << lane.astype(np.uint64), first)
            differ = words[run] ^ (np.uint64(0) - ((fp[query] >> bit[run]) & np.uint64(1)))
            # Carry-save: add one bit to each lane's count; a count above the radius sticks.
            for i, counter in enumerate(counters):
                counters[i], differ = counter ^ differ, counter & differ
            beyond |= differ | _above(counters, radius)
            if p % 4 == 3:
                alive = beyond != ALL
                run, query, beyond = run[alive], query[alive], beyond[alive]
                counters = [c[alive] for c in counters]
        within = ~beyond
        rows = np.flatnonzero(within)
        bits = np.unpackbits(within[rows].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, at = np.nonzero(bits)
        found_a.append(query[rows][row])
        found_b.append(low[run[rows][row]] + at)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is above the radius, by comparison from the highest bit down."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal = equal & counters[i]
        else:
            above |= equal & counters[i]
            equal = equal & ~counters[i]
    return above


def links_of(reps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links a, b between representatives of distinct fingerprints (columns fp, rep) within the
    radius: of the links that a task finds, a forest with the same components."""
    keys = choices(radius)
    masks = [signed(mask) for _, mask in keys]
    free = np.array([[PIECE * piece + i for piece in pieces for i in range(PIECE)] for pieces, _ in keys], np.int64).reshape(len(keys), -1)
    entries = reps.filter(F.col("rep").isNotNull()).select(
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("k", "m"), "fp", "rep"
    )
    entries = entries.repartition("k", "m").sortWithinPartitions("k", "m").select("k", "m", "fp", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = [np.zeros(0, np.int64)] * 4
        for batch in _with_end(batches):
            if batch is not None:
                got = [np.concatenate([x, c.to_numpy(zero_copy_only=False)]) for x, c in zip(left, batch.columns)]
            else:
                got = left
            k, m, fp, rep = got
            new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]))) if len(k) else np.zeros(0, int)
            # The last run may go on in the next batch; it has at most 2^16 rows.
            cut = len(k) if batch is None else int(new[-1]) if len(new) else 0
            left = [x[cut:] for x in got]
            new = new[new < cut]
            if len(new):
                a, b = close_pairs(fp[:cut].view(np.uint64), new, free[k[new]], radius)
                if len(a):
                    a, b = forest(rep[a], rep[b])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return entries.mapInArrow(compare, "a long, b long")


def _with_end(batches):
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    that links reach, links being fingerprints with at most ``radius`` different bits).

    Equal fingerprints are merged before the search, in the map tasks first. Each distinct one is
    sent to 28 keys, none of which can hold more than 65,536; only links between distinct
    fingerprints leave a task, as a forest. Components come from joins.

    Null and empty texts have fingerprint zero and link like others; a text of fewer words than a
    shingle is one shingle. Repeated rows link and stay; a row with a null id gets the component of
    its fingerprint, null if no row with an id shares it. An empty table gives no rows."""
    marks = saved(fingerprints(docs, size, seed, id_col, text_col), "fingerprints")
    reps = saved(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    links = saved(links_of(reps, radius), "fingerprint-links")
    parts = connected_components(links, "a", "b")
    classes = saved(
        reps.join(parts, F.col("rep") == F.col("node"), "left").select(
            F.col("fp").alias("__fp"), F.coalesce("component", "rep").alias("component_id")
        ),
        "fingerprint-components",
    )
    return marks.join(classes, F.col("fp") == F.col("__fp"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row, by id and a hash of the text, of each group of near-duplicates, with its columns.
    Groups are what links reach, links being fingerprints with at most ``radius`` different bits.

    A row is known by its id and text: rows of one id with different texts are judged apart, null
    ids (the last in order) like others. Of repeated rows of one id and text any one stays. Null and
    empty texts have fingerprint zero. An empty table gives no rows; columns may have any names."""
    own, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    place = [own.isNull().alias("no_id"), F.coalesce(own, F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("text_key")]
    marks = saved(with_fingerprints(docs.select(*place, text.alias("text")), size, seed), "fingerprints")
    classes = marks.select("fp", F.col("fp").alias("rep")).distinct()
    links = saved(links_of(classes, radius), "fingerprint-links")
    parts = connected_components(links, "a", "b")
    groups = marks.join(parts, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp").alias("group"))
    kept = saved(groups.agg(F.min(F.struct("no_id", "id", "text_key")).alias("first")).select("first.*"), "kept-documents")
    names = fresh_names(docs, "no_id", "id", "text_key")
    keyed = docs.withColumns({n: c for n, c in zip(names, place)})
    chosen = kept.select(*[F.col(c).alias(n) for c, n in zip(kept.columns, names)])
    return keyed.join(chosen, names, "left_semi").dropDuplicates(names).select(*[F.col(f"`{c}`") for c in docs.columns])
