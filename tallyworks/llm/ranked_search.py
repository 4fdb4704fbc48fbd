"""Ranked lexical search: terms at a time, rarest first, with a limit on new accumulators."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import texts_of

TOP = 20
#: Bytes of item texts that are searched for at a time, in one scan of the documents for statistics and one for scores.
BLOCK = 4 << 20
#: Occurrences of asked terms and documents that a task indexes at a time, and bytes of a text that are cut at a time.
SEGMENT, SEGMENT_DOCS, SLICE = 1 << 21, 1 << 16, 1 << 22
#: Groups in which the best documents of the tasks are first compared.
GROUPS = 32
#: Numbers under which the statistics of the whole collection are summed.
DOCUMENTS, LENGTHS = -1, -2

#: Bytes of terms: digits, A-Z as a-z, a-z and all that is not ASCII; others are blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    raw = text.encode("utf-8", "surrogatepass").translate(FOLD)
    low = 0
    while len(raw) - low > SLICE:
        cut = raw.find(b" ", low + SLICE)
        if cut < 0:
            break
        yield raw[low:cut].split()
        low = cut
    yield raw[low:].split()


class Segment:
    """Documents of a task with the asked terms they hold, as lists of places: by term, then document."""

    def __init__(self, ids: list, lengths: list[int], hits: list[int], held: list[int], n_terms: int):
        self.ids, self.lengths = ids, np.array(lengths, np.int64)
        size = max(1, len(ids))
        keys = np.array(hits, np.int64) * size + np.repeat(np.arange(len(ids)), held)
        pairs, self.tf = np.unique(keys, return_counts=True)
        self.doc = pairs % size
        self.starts = np.searchsorted(pairs, np.arange(n_terms + 1) * size)


def segments(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[Segment]:
    """Documents with at least one term, indexed in parts of bounded size."""
    get = vocabulary.get
    ids, lengths, hits, held = [], [], [], []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            before, n = len(hits), 0
            for terms in terms_of(text.as_py()):
                n += len(terms)
                hits += [t for w in terms if (t := get(w)) is not None]
            if n:
                ids.append(doc_id)
                lengths.append(n)
                held.append(len(hits) - before)
            if len(hits) >= SEGMENT or len(ids) >= SEGMENT_DOCS:
                yield Segment(ids, lengths, hits, held, len(vocabulary))
                ids, lengths, hits, held = [], [], [], []
    if ids:
        yield Segment(ids, lengths, hits, held, len(vocabulary))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def kth_best(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Search:
    """The best documents of a task for each item.

    ``items`` hold (term, times) with the rarest term first. The terms of an item are taken one at a
    time. A term opens accumulators for its documents as long as what this and the later terms can
    add reaches the k-th best score so far, of finished documents or of open accumulators; a document
    with none then cannot be among the best. From there on the open accumulators alone are updated,
    each exactly, and those that cannot reach that score any more are left out."""

    def __init__(self, items: list[list[tuple[int, int]]], weights: np.ndarray, n_docs: int, total: int, top: int):
        self.items, self.weights, self.n_docs, self.total, self.top = items, weights, n_docs, total, top
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none.astype(bool))] * len(items)
        self.opened = self.updated = 0

    def add(self, part: Segment) -> None:
        m = 75 + (25 * part.lengths * self.n_docs) // self.total
        tf = part.tf.astype(np.int64)
        term = np.repeat(np.arange(len(part.starts) - 1), np.diff(part.starts))
        gain = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[part.doc]))
        most = np.zeros(len(part.starts) - 1, np.int64)
        filled = np.flatnonzero(np.diff(part.starts))
        if len(filled):
            most[filled] = np.maximum.reduceat(gain, part.starts[filled])
        ids = np.array([0 if i is None else i for i in part.ids], np.int64)
        null = np.array([i is None for i in part.ids], bool)
        sums = np.zeros(len(ids), np.int64)
        for item, terms in enumerate(self.items):
            docs, scores = self._accumulate(part, gain, sums, [(t, q, q * int(most[t])) for t, q in terms if most[t]], self._floor(item))
            if len(docs):
                self._keep(item, scores, ids[docs], null[docs])

    def _floor(self, item: int) -> int:
        scores = self.best[item][0]
        return int(scores[-1]) if len(scores) == self.top else 0

    def _accumulate(self, part, gain, sums, terms, floor) -> tuple[np.ndarray, np.ndarray]:
        left = list(accumulate((most for _, _, most in reversed(terms)), initial=0))[::-1]
        at, opened = 0, np.zeros(0, np.int64)
        while at < len(terms) and left[at] >= floor:
            t, times, _ = terms[at]
            low, high = part.starts[t], part.starts[t + 1]
            docs = part.doc[low:high]
            more = times * gain[low:high]
            new = docs[(sums[docs] == 0) & (more > 0)]
            sums[docs] += more
            opened = np.concatenate([opened, new])
            floor = max(floor, kth_best(sums[opened], self.top))
            at += 1
        scores = sums[opened]
        sums[opened] = 0
        self.opened += len(opened)
        for i in range(at, len(terms)):
            alive = scores + left[i] >= floor
            opened, scores = opened[alive], scores[alive]
            t, times, _ = terms[i]
            low, high = part.starts[t], part.starts[t + 1]
            place = low + np.minimum(np.searchsorted(part.doc[low:high], opened), high - low - 1)
            held = part.doc[place] == opened
            scores = scores + np.where(held, times * gain[place], 0)
            floor = max(floor, kth_best(scores, self.top))
            self.updated += len(opened)
        return opened, scores

    def _keep(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        old = self.best[item]
        scores, ids, null = (np.concatenate(pair) for pair in zip(old, (scores, ids, null)))
        order = np.lexsort((ids, null, -scores))[: self.top]
        self.best[item] = scores[order], ids[order], null[order]

    def results(self, group: int) -> pa.RecordBatch:
        sizes = [len(scores) for scores, _, _ in self.best]
        scores, ids, null = (np.concatenate([b[i] for b in self.best]) for i in range(3))
        columns = [pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()), pa.array(np.full(len(ids), group), pa.int32())]
        columns += [pa.array(ids, mask=null), pa.array(scores)]
        return pa.RecordBatch.from_arrays(columns, names=["item", "part", "doc_id", "score"])


def _search_block(texts: DataFrame, asked: list, top: int) -> DataFrame:
    """item (its number in ``asked``), rank, doc_id and score of the best documents of some items."""
    spark = texts.sparkSession
    counts = [Counter(w for terms in terms_of(text or "") for w in terms) for _, text in asked]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
    known = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(len(known.value), np.int64), 0, 0
        for part in segments(batches, known.value):
            df += np.diff(part.starts)
            n += len(part.ids)
            total += int(part.lengths.sum())
        held = np.flatnonzero(df)
        keys, sums = np.append(held, [DOCUMENTS, LENGTHS]), np.append(df[held], [n, total])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(sums)], names=["term", "n"])

    found = dict(map(tuple, texts.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()))
    n_docs, total = found.get(DOCUMENTS, 0), found.get(LENGTHS, 0)
    weights = np.array([weight(n_docs, found.get(t, 0)) for t in range(len(vocabulary))], np.int64)
    items = [sorted(((vocabulary[w], q) for w, q in c.items()), key=lambda x: (found.get(x[0], 0), x[0])) for c in counts]
    plan = spark.sparkContext.broadcast((items, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*plan.value, n_docs, total, top)
        for part in segments(batches, known.value):
            search.add(part)
        yield search.results(TaskContext.get().partitionId() % GROUPS)

    scored = texts.mapInArrow(score, "item int, part int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "part"], ["item"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return scored.select("item", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. Weights
    and lengths come from all documents, in one scan that sums per task. In a second scan each task
    indexes its documents in parts of bounded size and searches them (see ``Search``); it carries
    the best scores of an item from part to part and hands on at most ``top`` rows an item. Items
    are searched in blocks of about ``block`` bytes, so what is sent to tasks is bounded (a longer
    item is a block of its own).

    Null and empty texts have no terms: such documents are not counted, such items find nothing.
    Rows with a null or repeated doc_id are ranked like others, null after all ids at equal scores.
    Repeated items (same id and text) are one; texts under one item_id are ranked each. Long texts
    are used whole. Empty tables give no rows; other columns are not read."""
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    asked = items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block) or 1
    results = []
    for number in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).sort("item_id", "text").collect()
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(own)], asked.select(F.lit(0).alias("item"), "item_id").schema)
        if own:
            results.append(_search_block(texts, [tuple(r) for r in own], top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    found = results[0] if results else spark.createDataFrame([], asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).schema)
    for more in results[1:]:
        found = found.unionByName(more)
    return found
