"""Near-duplicate lines: an exact set-similarity join by prefix, position and length filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import saved, texts_of
from tallyworks.llm.components import connected_components, forest
from tallyworks.llm.line_sets import Lines, Powers, by_rarity, line_sets

THRESHOLD = 0.8
#: Counters of the rarity sketch, a table of fixed size. Tokens share counters, which only changes
#: the order of tokens, not the result; a counter is never below the count of one of its tokens.
SKETCH_BITS = 20
CHUNK = 1 << 12
#: A token whose counter is above this is compared in tiles of two blocks of about as many lines.
BLOCK = 8_192
#: Lines of a component that are verified against each other at a time.
VERIFY = 512
#: Tokens of pairs of lines that are sorted at a time to count the common ones.
SORTED = 1 << 21
#: Membership filters have some 16 to 32 bits for each line with candidates, 2^FILTER_BITS at most;
#: false hits are joined away.
FILTER_BITS = 27
LAST = (1 << 63) - 1


def occurrences(docs: DataFrame) -> DataFrame:
    """One scan, two kinds of rows: the lines with tokens of each document that has any (doc_id,
    text_key, lines, classes) and, at the end of a task, its token counts in chunks (chunk, counts)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts = Powers(), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            rows, numbers, classes = [], [], []
            for lines in line_sets(batch.column(2), powers):
                counts += np.bincount((lines.tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                rows.append(lines.row)
                numbers.append(lines.number.astype(np.int32))
                classes.append(lines.classes())
            row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            if len(row):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                at, ends = pa.array(row[first]), pa.array(np.append(first, len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(numbers))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(classes))), pa.nulls(len(first), pa.int32()), pa.nulls(len(first), pa.binary())],
                    names=[n for n, _ in OCCURRENCE],
                )
        used = [c for c in range(0, len(counts), CHUNK) if counts[c : c + CHUNK].any()]
        yield _batch(OCCURRENCE, [*[[None] * len(used)] * 4, [c // CHUNK for c in used], [counts[c : c + CHUNK].tobytes() for c in used]])

    return docs.mapInArrow(scan, "doc_id long, text_key long, lines array<int>, classes array<long>, chunk int, counts binary")


OCCURRENCE = [
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("lines", pa.list_(pa.int32())), ("classes", pa.list_(pa.int64())),
    ("chunk", pa.int32()), ("counts", pa.binary()),
]


def _batch(fields, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def sketch(found: DataFrame) -> np.ndarray:
    """The counters over all lines: chunks are added up in tasks, 2^20 numbers come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.frombuffer(row.as_buffer(), np.int64)
                sums[chunk] = sums[chunk] + row if chunk in sums else row.copy()
        if sums:
            yield _batch([("chunk", pa.int32()), ("counts", pa.binary())], [list(sums), [v.tobytes() for v in sums.values()]])

    parts = found.filter(F.col("chunk").isNotNull()).select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in parts.toArrow().to_pylist():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.minimum(np.frombuffer(row["counts"], np.int64), 2**32 - 1)
    return counts


def least_overlap(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)


def most_different(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    return np.floor((1 - threshold) / (1 + threshold) * (n + m) + 1e-9)


def parity(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a set: whether an even number of its tokens falls on each. Two sets differ in at
    most as many bits as tokens."""
    bit = np.uint64(1) << (tokens & np.uint64(63))
    first = (tokens & np.uint64(64)) == 0
    zero = np.uint64(0)
    return (
        np.bitwise_xor.reduceat(np.where(first, bit, zero), starts),
        np.bitwise_xor.reduceat(np.where(first, zero, bit), starts),
    )


#: Values of the entries of a bucket, each as the bytes of one array.
LIST = [("token", np.uint32), ("tile", np.int64), ("side", np.int8), ("class", np.int64), ("n", np.int32), ("at", np.int32), ("p", np.uint64), ("q", np.uint64)]
LIST_SCHEMA = ", ".join(["bucket int", *[f"{n} binary" for n, _ in LIST]])


def prefix_entries(docs: DataFrame, counts, buckets: int, threshold: float) -> DataFrame:
    """The prefix tokens of every distinct line of a task, in arrays for each bucket of tokens.

    A line's tokens are ordered by rarity; two lines with a Jaccard similarity of ``threshold``
    share one of their first ``n - ceil(threshold * n) + 1``. A token whose counter is 1 is in no
    second line and stays out. A frequent token's lines are dealt to blocks and sent to each tile of
    two blocks that theirs is in."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, rarity = Powers(), counts.value
        seen: set[int] = set()
        for batch in batches:
            for lines in line_sets(batch.column(2), powers):
                classes = lines.classes()
                fresh = np.zeros(len(classes), bool)
                for i, known in enumerate(classes.tolist()):
                    if known not in seen:
                        seen.add(known)
                        fresh[i] = True
                if fresh.any():
                    yield from _entries(classes[fresh], lines.only(fresh), rarity, buckets, threshold)

    return docs.mapInArrow(scan, LIST_SCHEMA)


def _entries(classes, lines: Lines, rarity, buckets, threshold) -> Iterator[pa.RecordBatch]:
    sizes, starts = lines.sizes, lines.starts
    p, q = parity(lines.tokens, starts)
    token, count = by_rarity(lines, rarity[(lines.tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64))
    line = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(token)) - np.repeat(starts, sizes)
    length = sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1
    kept = (at < length[line]) & (count > 1)
    token, count, line, at = token[kept], count[kept], line[kept], at[kept]
    blocks = -(-count // BLOCK)
    copies = np.where(blocks > 1, blocks, 1)
    entry = np.repeat(np.arange(len(token)), copies)
    other = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    token, line, at, blocks = token[entry], line[entry], at[entry], copies[entry]
    own = (classes[line].view(np.uint64) >> np.uint64(20)) % blocks.astype(np.uint64)
    own = own.astype(np.int64)
    tile = (np.minimum(own, other) << 31) + np.maximum(own, other)
    side = np.where(own == other, 0, np.where(own < other, 1, 2)).astype(np.int8)
    short = (token >> np.uint64(32)).astype(np.uint32)
    bucket = (short.astype(np.int64) * 2654435761 + tile * 40503) % 4294967291 % buckets
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    values = [short, tile, side, classes[line], sizes[line], at, p[line], q[line]]
    bucket = bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut, len(bucket))
    arrays = [pa.array(bucket[cut].astype(np.int32))]
    for (_, kind), v in zip(LIST, values):
        width = np.dtype(kind).itemsize
        v = np.ascontiguousarray(v[order].astype(kind, copy=False))
        arrays.append(pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(v)]))
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *[n for n, _ in LIST]])


def candidate_links(entries: DataFrame, buckets: int, threshold: float) -> DataFrame:
    """Links a, b between classes that pass the length, position and parity filters in some list:
    a forest of those that a bucket holds, never all pairs."""
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _buckets(batches):
            a, b = _candidates(*columns, threshold)
            if len(a):
                a, b = forest(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def _buckets(batches):
    held, last = [], None
    for batch in batches:
        for row in range(batch.num_rows):
            bucket = batch.column(0)[row].as_py()
            if last is not None and bucket != last:
                yield [np.concatenate(c) for c in zip(*held)]
                held = []
            last = bucket
            held.append([np.frombuffer(batch.column(k)[row].as_buffer(), kind) for k, (_, kind) in enumerate(LIST, 1)])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _candidates(token, tile, side, known, n, at, p, q, threshold):
    if n.max(initial=0) < 1 << 12:
        # One packed key for lists that are not cut in tiles. Equal classes are neighbours there but
        # for a few with others of their size and last bits between them, which then come twice.
        whole, cut = np.flatnonzero(tile == 0), np.flatnonzero(tile)
        key = (token[whole].astype(np.uint64) << np.uint64(32)) | (n[whole].astype(np.uint64) << np.uint64(20))
        whole = whole[np.argsort(key | (known[whole].view(np.uint64) & np.uint64((1 << 20) - 1)))]
        order = np.concatenate([whole, cut[np.lexsort((known[cut], n[cut], tile[cut], token[cut]))]])
    else:
        order = np.lexsort((known, n, tile, token))
    token, tile, side, known, n, at, p, q = (x[order] for x in (token, tile, side, known, n, at, p, q))
    fresh = np.append(True, (token[1:] != token[:-1]) | (tile[1:] != tile[:-1]) | (known[1:] != known[:-1]) | (at[1:] != at[:-1])) if len(token) else np.zeros(0, bool)
    token, tile, side, known, n, at, p, q = (x[fresh] for x in (token, tile, side, known, n, at, p, q))
    found_a, found_b = [], []
    low, gap = np.arange(max(0, len(token) - 1)), 1
    while len(low):
        low = low[low + gap < len(token)]
        high = low + gap
        # Sizes rise inside a list: past a line that is too long, all later ones are.
        on = (token[high] == token[low]) & (tile[high] == tile[low]) & (n[low] >= threshold * n[high] - 1e-9)
        low, high = low[on], high[on]
        left = 1 + np.minimum(n[low] - at[low] - 1, n[high] - at[high] - 1)
        ok = (left >= least_overlap(n[low], n[high], threshold)) & (known[low] != known[high])
        ok &= (side[low] == 0) | (side[low] != side[high])
        x, y = low[ok], high[ok]
        differ = np.bitwise_count(p[x] ^ p[y]).astype(np.int64) + np.bitwise_count(q[x] ^ q[y])
        near = differ <= most_different(n[x], n[y], threshold)
        found_a.append(known[x[near]])
        found_b.append(known[y[near]])
        gap += 1
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _filter(keys: DataFrame, bits: int) -> np.ndarray:
    """Which leading ``bits`` bits the keys have, as a flag for each: 2^bits bits come to the driver."""
    words = (
        keys.toDF("key").select(F.shiftrightunsigned("key", 64 - bits).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))).alias("bits"))
    )
    flags = np.zeros(1 << (bits - 6), np.int64)
    got = words.toArrow()
    flags[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return flags.view(np.uint64)


def _passes(words: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def member_tokens(docs: DataFrame, members: DataFrame) -> DataFrame:
    """class and tokens (as bytes) of the lines that have a candidate, from the place of their rank.
    Filters of bounded size drop other documents before they are cut into lines, and most other
    lines; the caller's join drops the rest. A class may come from more than one task."""
    bits = min(FILTER_BITS, max(16, 4 + members.count().bit_length()))
    place = F.xxhash64("rank.doc_id", "rank.text_key")
    filters = docs.sparkSession.sparkContext.broadcast(
        [_filter(members.select(place), bits), _filter(members.select(place.bitwiseXOR(F.col("class"))), bits)]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = Powers(), set()
        of_places, of_lines = filters.value
        for batch in batches:
            places = batch.column(0).to_numpy()
            held = _passes(of_places, places, bits)
            places = places[held]
            for lines in line_sets(batch.column(1).filter(pa.array(held)), powers):
                classes = lines.classes()
                keep = _passes(of_lines, classes ^ places[lines.row], bits)
                for i in np.flatnonzero(keep).tolist():
                    keep[i] = classes[i] not in seen
                    seen.add(classes[i])
                lines = lines.only(keep)
                ends = pa.py_buffer((np.append(0, np.cumsum(lines.sizes)) * 8).astype(np.int32))
                tokens = pa.Array.from_buffers(pa.binary(), len(lines.sizes), [None, ends, pa.py_buffer(np.ascontiguousarray(lines.tokens))])
                yield pa.RecordBatch.from_arrays([pa.array(classes[keep]), tokens], names=["class", "tokens"])

    placed = docs.select(F.xxhash64(F.coalesce("doc_id", F.lit(LAST)), "text_key").alias("place"), "text")
    return placed.mapInArrow(scan, "class long, tokens binary")


def verified(lines: DataFrame, members: DataFrame, threshold: float, block: int = VERIFY) -> DataFrame:
    """class, n_links (lines of other classes) and has_earlier for the classes with links, from lines
    (class, component, tokens, rank, copies; a class may come twice) and members (each class once). A
    component of more than ``block`` classes is dealt to blocks and compared in tiles."""
    sizes = saved(members.groupBy("component").agg(F.count("*").alias("members")), "line-components")
    dealt = lines.join(sizes.hint("shuffle_hash"), "component").withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = dealt.select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "own", "rank.doc_id", "rank.text_key", "rank.line", "copies", "tokens"
    )
    key = ["component", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _tiles(batches):
            classes, count, earlier = _verify(*columns, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(count), pa.array(earlier)], names=["class", "n", "earlier"])

    found = tiles.repartition(*key).sortWithinPartitions(*key, "class").mapInArrow(compare, "class long, n long, earlier boolean")
    return found.groupBy("class").agg(F.sum("n").alias("n_links"), F.max("earlier").alias("has_earlier"))


def _tiles(batches):
    """Columns of rows of whole tiles, each class of a tile once, and the numbers of tokens and the
    tokens of the rows."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens = batch.column(9)
        ends = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset : tokens.offset + len(tokens) + 1] // 8
        values = np.frombuffer(tokens.buffers()[2], np.uint64, count=ends[-1])[ends[0] :]
        part = [*[batch.column(k).to_numpy() for k in range(9)], np.diff(ends).astype(np.int64)]
        if held:
            part, values = [np.concatenate(c) for c in zip(held[0], part)], np.concatenate([held[1], values])
        fresh = _changes(*part[:4])
        part, values = [c[fresh] for c in part], values[np.repeat(fresh, part[9])]
        last = int(np.flatnonzero(_changes(*part[:3]))[-1])
        cut = int(part[9][:last].sum())
        if last:
            yield [*[c[:last] for c in part], values[:cut]]
        held = [c[last:] for c in part], values[cut:]
    if held:
        yield [*held[0], held[1]]


def _changes(*columns) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _verify(component, i, j, known, own, doc_id, text_key, line, copies, n, tokens, threshold):
    """The classes with links, their numbers of links and whether one is earlier, of whole tiles."""
    tile = np.cumsum(_changes(component, i, j))
    starts = np.cumsum(n) - n
    p, q = parity(tokens, starts)
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((line, text_key, doc_id))] = np.arange(len(n))
    order = np.lexsort((n, tile))
    count, earlier = np.zeros(len(n), np.int64), np.zeros(len(n), bool)
    _, ids = np.unique(tokens, return_inverse=True)
    low, gap = np.arange(len(n) - 1), 1
    waiting, size = [], 0

    def settle():
        x, y = (np.concatenate(c) for c in zip(*waiting))
        common = _common(x, y, starts, n, ids)
        near = common >= threshold * (n[x] + n[y] - common) - 1e-9
        x, y = x[near], y[near]
        np.add.at(count, x, copies[y])
        np.add.at(count, y, copies[x])
        earlier[np.where(rank[x] < rank[y], y, x)] = True
        waiting.clear()

    while len(low):
        low = low[low + gap < len(n)]
        x, y = order[low], order[low + gap]
        # Sizes rise inside a tile: past a line that is too long, all later ones are.
        on = (tile[x] == tile[y]) & (n[x] >= threshold * n[y] - 1e-9)
        low, x, y = low[on], x[on], y[on]
        differ = np.bitwise_count(p[x] ^ p[y]).astype(np.int64) + np.bitwise_count(q[x] ^ q[y])
        ok = (differ <= most_different(n[x], n[y], threshold)) & ((i[x] == j[x]) | (own[x] != own[y]))
        if ok.any():
            waiting.append((x[ok], y[ok]))
            size += int((n[x[ok]] + n[y[ok]]).sum())
            if size > SORTED:
                settle()
                size = 0
        gap += 1
    if waiting:
        settle()
    has = np.flatnonzero(count)
    return known[has], count[has], earlier[has]


def _common(x, y, starts, n, ids) -> np.ndarray:
    """How many tokens the lines x and y have in common, pair by pair."""
    common = np.zeros(len(x), np.int64)
    sizes, low = np.cumsum(n[x] + n[y]), 0
    while low < len(x):
        done = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, done + SORTED, "right")))
        lines = np.concatenate([x[low:high], y[low:high]])
        pair = np.tile(np.arange(high - low), 2)
        lengths = n[lines]
        at = np.repeat(starts[lines] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        key = np.sort((np.repeat(pair, lengths) << 32) | ids[at])
        common[low:high] = np.bincount(key[1:][key[1:] == key[:-1]] >> 32, minlength=high - low)
        low = high
    return common


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without its repeated lines, and n_lines, n_removed and
    n_links (other lines of the corpus that the document's lines match).

    A line is the set of its tokens, A-Z lower-cased and cut at white space. Lines match when the
    Jaccard similarity of their sets is at least ``threshold``; equal sets always do. In the order
    of doc_id, text and line number, a line that matches an earlier one is removed.

    Lines without tokens stay. A null text stays null, an empty one empty. Repeated rows (same id,
    same text) are one document and keep the same lines; a null id comes last. Empty tables give no
    rows. Long texts and lines are used whole."""
    texts = texts_of(docs, id_col, text_col).select("doc_id", text_key_of(F.col("text")).alias("text_key"), "text")
    found = saved(occurrences(texts), "line-occurrences")
    counts = docs.sparkSession.sparkContext.broadcast(sketch(found))
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = prefix_entries(texts, counts, buckets, threshold)
    links = saved(candidate_links(entries, buckets, threshold), "line-candidates")
    parts = saved(connected_components(links, "a", "b"), "line-candidate-components")
    members = (
        parts.select(F.col("node").alias("class"), "component")
        .unionByName(parts.select(F.col("component").alias("class"), "component"))
        .distinct()
    )
    places = found.filter(F.col("chunk").isNull()).select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "text_key", "lines", "classes")
    # Repeated rows are one document: they are made one once, for the classes and for the verdicts.
    places = saved(places.dropDuplicates(["doc_id", "text_key"]), "line-places")
    lines = places.select("doc_id", "text_key", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("classes").alias("class"))))
    place = F.struct("doc_id", "text_key", "line")
    firsts = saved(lines.groupBy("class").agg(F.min(place).alias("rank"), F.count(F.lit(1)).alias("copies")), "line-classes")
    members = saved(firsts.join(members.hint("shuffle_hash"), "class").select("class", "component", "rank", "copies"), "line-members")
    joined = saved(member_tokens(texts, members).join(members, "class"), "line-member-tokens")
    checked = saved(verified(joined, members, threshold), "line-links")
    # Lines that occur once and have no link are counted only.
    repeated = firsts.filter(F.col("copies") > 1).join(checked, "class", "left")
    single = members.filter(F.col("copies") == 1).join(checked, "class")
    columns = ["class", "rank", "copies", "n_links", "has_earlier"]
    classes = saved(repeated.select(columns).unionByName(single.select(columns)).select(
        F.col("class").alias("__class"), "rank", "copies", F.coalesce("n_links", F.lit(0)).alias("n"), F.coalesce("has_earlier", F.lit(False)).alias("earlier")
    ), "line-verdicts")
    judged = lines.join(classes.hint("shuffle_hash"), F.col("class") == F.col("__class")).select(
        "doc_id", "text_key", "line", F.lit(0).alias("lines"), (F.col("n") + F.col("copies") - 1).alias("n"), (F.col("earlier") | (place != F.col("rank"))).alias("gone")
    )
    counted = places.select("doc_id", "text_key", F.lit(None).cast("int").alias("line"), F.size("classes").alias("lines"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("gone"))
    judged = judged.unionByName(counted).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "line", "lines", "n", "gone")
    per_doc = judged.repartition("__id", "__key").groupBy("__id", "__key").agg(
        F.sum("lines").alias("n_lines"),
        F.sum(F.col("gone").cast("long")).alias("n_removed"),
        F.sum("n").alias("n_links"),
        F.collect_list(F.when(F.col("gone"), F.col("line"))).alias("__gone"),
    )
    text = F.col(f"`{text_col}`")
    keyed = docs.drop("n_lines", "n_removed", "n_links").withColumns(
        {"__own_id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)), "__own_key": text_key_of(text)}
    )
    result = keyed.join(per_doc.hint("shuffle_hash"), (F.col("__own_id") == F.col("__id")) & (F.col("__own_key") == F.col("__key")), "left")
    # A column of its own: inside the function over the lines, a text would be split again for each line.
    result = result.withColumn("__pieces", F.when(F.col("n_removed") > 0, F.split(text, "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("__pieces") - 1), "__gone")
    rebuilt = F.array_join(F.transform(left, lambda i: F.get("__pieces", i)), "\n")
    return result.withColumn(text_col, F.when(F.col("n_removed") > 0, rebuilt).otherwise(text)).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed", "n_links")],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_removed", "n_links")],
    )


def text_key_of(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))
