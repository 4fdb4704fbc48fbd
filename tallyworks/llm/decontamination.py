"""Benchmark items inside documents: size-partitioned bottom-k MinHash, then exact containment.

DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import saved

SHINGLE = 5
CONTAINMENT = 0.8
#: A side is broadcast only when it is counted to have at most so many rows of a few numbers.
BROADCAST_ROWS = 200_000

# Bytes of ASCII that are neither digits nor lower-case letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, although the body names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(words: Column, length: int) -> Column:
    """A hash of each run of ``length`` words; fewer words: none."""

    def runs(h: Column) -> Column:
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (length - 1), F.lit(0)))
        return F.transform(
            starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, length)])
        )

    return bound(F.transform(words, lambda w: F.xxhash64(w)), runs)


def shingle_texts(words: Column, length: Column) -> Column:
    """The distinct runs of ``length`` words, as texts."""

    def runs(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - length + 1, F.lit(0)))
        return F.array_distinct(
            F.transform(starts, lambda _, i: F.array_join(F.slice(w, i + 1, length), " "))
        )

    return bound(words, runs)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast where counting shows at most ``rows`` rows, else left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def item_sketches(items: DataFrame, item_id: str, text: str, threshold: float) -> DataFrame:
    """item_id, length (words of a shingle), n (distinct shingles), need and sketch.

    Items are partitioned by size: those with 2^c to 2^(c+1)-1 shingles get the same number of
    smallest hashes. An item may miss ``allowed`` of its shingles in a document, so of ``k``
    smallest hashes at least ``need = k - allowed`` must be there; the largest size of the
    partition makes ``need`` at least 1 for each item."""
    words = items.select(F.col(f"`{item_id}`").alias("item_id"), words_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("w"))
    words = words.filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(SHINGLE)))
    hashes = F.lit(None).cast("array<long>")
    for length in range(1, SHINGLE + 1):
        hashes = F.when(F.col("length") == length, shingle_hashes(F.col("w"), length)).otherwise(hashes)
    table = words.withColumn("h", F.array_sort(F.array_distinct(hashes))).withColumn("n", F.size("h"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1
    missing = lambda n: F.floor(n * (1 - threshold) + 1e-9)
    table = table.withColumn("k", F.least((missing(largest) + 1).cast("int"), F.col("n")))
    return table.select(
        "item_id",
        "length",
        "n",
        F.greatest(F.col("k") - missing(F.col("n")), F.lit(1)).cast("int").alias("need"),
        F.slice("h", F.lit(1), F.col("k")).alias("sketch"),
        shingle_texts(F.col("w"), F.col("length")).alias("shingles"),
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs (doc_id, item_id) where the document holds at least ``threshold`` of the item's
    distinct shingles of five words; n_shingles, n_shared and containment with them.

    A shorter item is one shingle of all its words, looked for anywhere in the document. The
    hashes of a document's shingles are computed in the scan and probed against the sketches; only
    hits are shuffled. No pair is lost by the sketch, and each is verified on the words themselves.

    Null and empty texts match nothing. Rows of one doc_id that hold the item are one pair, with the
    best containment; repeated items give one pair for each item_id, of the best. Empty tables give
    no rows; other columns are not read."""
    sketches = saved(item_sketches(items, item_id_col, item_text_col, threshold), "benchmark-sketches")
    lengths = [r[0] for r in sketches.select("length").distinct().collect()]  # at most five
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    numbered = sketches.withColumn("__item", F.xxhash64("item_id", "shingles"))
    probes = numbered.select("__item", "need", "length", F.explode("sketch").alias("hash")).distinct()
    words = bound(
        words_of(F.col("text")),
        lambda w: F.array_distinct(F.flatten(F.array(*[shingle_hashes(w, n) for n in lengths or [SHINGLE]]))),
    )
    hits = texts.select("doc_id", F.explode(words).alias("hash")).join(small(probes), "hash")
    found = (
        hits.groupBy("doc_id", "__item", "need")
        .agg(F.countDistinct("hash").alias("n_hits"))
        .filter(F.col("n_hits") >= F.col("need"))
        .select("doc_id", "__item")
    )
    found = saved(found, "benchmark-candidates")
    pairs = texts.join(small(found), "doc_id").join(
        small(numbered.select("__item", "item_id", "length", "n", "shingles"), 2_000), "__item"
    )
    shared = F.size(F.array_intersect(shingle_texts(words_of(F.col("text")), F.col("length")), F.col("shingles")))
    return (
        pairs.select("doc_id", "item_id", F.size("shingles").alias("n_shingles"), shared.alias("n_shared"))
        .filter(F.col("n_shared") >= F.col("n_shingles") * threshold - 1e-9)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_shared")).alias("best"))
        .select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT, **names) -> DataFrame:
    """The documents that hold no item. A row is known by its id and text: rows of one id are judged
    apart, null ids like others."""
    row = F.xxhash64(F.col(f"`{names.get('id_col', 'doc_id')}`"), F.coalesce(F.col(f"`{names.get('text_col', 'text')}`"), F.lit("")))
    keyed = docs.withColumn("__row", row)
    bad = contaminated(keyed, items, threshold, **names | {"id_col": "__row"}).select(F.col("doc_id").alias("__bad")).distinct()
    kept = keyed.join(small(saved(bad, "contaminated")), F.col("__row") == F.col("__bad"), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
