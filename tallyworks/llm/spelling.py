"""Spelling variants: words one edit apart, found by pivotal bigrams in other words' rare prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import drop_saved, saved

#: Shortest word, fewest occurrences, and how much more frequent a form is than its variant.
LENGTH, OCCURRENCES, RATIO = 7, 2, 10
#: One run in so many loses a letter before it is counted.
DAMAGED = 31
#: Words that a task counts before it hands the counts on.
HELD = 400_000
#: Characters of a text that are cut at a time (a piece ends where a run does).
PIECE = 1 << 20
#: Words in a list of the index above which its members are matched by what an edit leaves of them.
CROWDED = 512
#: Rare bigrams of a word's prefix: one edit destroys at most two, so a third stays. Of the prefix two
#: that share no letter are the pivots: one edit destroys at most one.
PREFIX, PIVOTS = 3, 2
#: Occurrences of a bigram that a prefix holds: an edit may put two more before one of the first three.
REPEATS = PREFIX + 2
#: Letters of an open part up to which it is matched by what an edit leaves of it, beyond by its halves.
SHORT = 64

#: Letters as one byte each: A-Z lower-cased, a-z, U+00C0 to U+00FF; others are blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str) -> Iterator[list[bytes]]:
    """Runs of letters in lists of bounded size, a letter being one byte."""
    raw = text.encode("latin-1", "replace").translate(FOLD)
    low = 0
    while len(raw) - low > PIECE:
        cut = raw.find(b" ", low + PIECE)
        if cut < 0:
            break
        yield raw[low:cut].split()
        low = cut
    yield raw[low:].split()


def damaged(runs: list[bytes], start: int, length: int) -> list[bytes]:
    """The runs with at least ``length`` letters after one in 31, by its checksum, has lost a letter."""
    out, crc = [], zlib.crc32
    for run in runs:
        if len(run) >= length:
            h = crc(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % DAMAGED:
                out.append(run)
            elif len(run) > length:
                at = h % len(run)
                out.append(run[:at] + run[at + 1 :])
    return out


def word_counts(docs: DataFrame, length: int, fewest: int, id_col: str, text_col: str) -> DataFrame:
    """word and n, its occurrences in all documents; sums are formed in the tasks first."""
    texts = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )

    def batch_of(counts: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        get = counts.get
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{doc_id}:".encode())
                for runs in runs_of(text.as_py()):
                    for word in damaged(runs, start, length):
                        counts[word] = get(word, 0) + 1
                    if len(counts) > HELD:
                        yield batch_of(counts)
                        counts.clear()
        if counts:
            yield batch_of(counts)

    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def bigram_counts(words: DataFrame) -> np.ndarray:
    """How many words hold each pair of letters, at most 90 * 90 of them, indexed by both bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                raw = word.encode("latin-1")
                for gram in set(zip(raw, raw[1:])):
                    total[gram[0] << 8 | gram[1]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["gram", "n"])

    rows = words.select("word").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect()
    counts = np.zeros(1 << 16, np.int64)
    for gram, n in rows:
        counts[gram] = n
    return counts


def pivots_of(places: list[int], weights: list[int], count: int = PIVOTS, width: int = 2) -> list[int]:
    """Of bigram places in rising order ``count`` that share no letter, with the least total weight.

    ``best[j]`` is the least weight of j bigrams among the places read so far, the last one ending at or
    before the place; ties keep the earlier ones."""
    done: list[list[tuple[int, tuple[int, ...]]]] = []
    for i, place in enumerate(places):
        before = next((done[j] for j in range(i - 1, -1, -1) if places[j] + width <= place), [(0, ())])
        best = list(done[-1]) if done else [(0, ())]
        for total, chosen in before[:count]:
            new = (total + weights[i], (*chosen, place))
            at = len(chosen) + 1
            if at == len(best):
                best.append(new)
            elif new[0] < best[at][0]:
                best[at] = new
        done.append(best)
    return list(done[-1][count][1])


def rare_places(raw: bytes, order: np.ndarray) -> tuple[list[int], list[int], int]:
    """Places of the three rarest bigrams (of equal ones the first), places of the bigrams that are as
    rare as the third, and its rank."""
    ranks = [int(order[a << 8 | b]) for a, b in zip(raw, raw[1:])]
    own = sorted(range(len(ranks)), key=ranks.__getitem__)[:PREFIX]
    last, held, prefix = ranks[own[-1]], {}, []
    for i, rank in enumerate(ranks):
        if rank <= last and held.setdefault(rank, 0) < REPEATS:
            held[rank] += 1
            prefix.append(i)
    return sorted(own), prefix, last


def _key(side: int, place: int, part: bytes) -> int:
    return xxhash.xxh64_intdigest(part, seed=2 * place + side) - (1 << 63)


def entries_of(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """The index: key, role (0 pivot, 1 prefix), word, n, last (rank of the prefix's last bigram) and
    at, where the part of the word that the key leaves open lies: after so many letters, or before.

    An edit lies right of the first pivot or left of the second. So a pair agrees in the first pivot,
    its place from the start and all letters before it, or in the second pivot, its place from the end
    and all letters after it: that is the key. The open part holds the edit. A pivot that an edit leaves
    is one of the first occurrences of its bigram in both words, so an entry for these is enough."""
    order = np.zeros(1 << 16, np.int64)
    order[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16)
    sent = words.sparkSession.sparkContext.broadcast((counts, order))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, order = sent.value
        for batch in batches:
            for low in range(0, batch.num_rows, 1_000):
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                part = batch.slice(low, 1_000)
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    raw = word.encode("latin-1")
                    own, prefix, last = rare_places(raw, order)
                    first, second = pivots_of(own, [int(held[raw[p] << 8 | raw[p + 1]]) for p in own])
                    size = len(raw)
                    for role, lefts, rights in ((0, (first,), (second,)), (1, prefix, prefix)):
                        for p in lefts:
                            for k, v in zip(rows, (_key(0, p, raw[: p + 2]), role, word, n, last, p + 2)):
                                k.append(v)
                        for p in rights:
                            for k, v in zip(rows, (_key(1, size - p, raw[p:]), role, word, n, last, -p)):
                                k.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, TYPES)], names=NAMES)

    return words.select("word", "n").mapInArrow(index, ", ".join(map(" ".join, zip(NAMES, ["long", "int", "string", "long", "int", "int"]))))


NAMES = ["key", "role", "word", "n", "last", "at"]
TYPES = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32()]


def shared_parts(rest: bytes, role: int) -> set[int]:
    """Hashes of which two open parts that one edit changes into each other share one: of the part and
    of the part without each one of its letters, if it is short; else of its halves, of which the edit
    leaves one. A prefix's part also has those that a pivot's part of one letter more or less asks for."""
    size, found = len(rest), set()
    if size <= SHORT + role:
        found |= {_key(2, 0, rest)} | {_key(2, 0, rest[:i] + rest[i + 1 :]) for i in range(size)}
    if size > SHORT - role:
        for other in {size} if role == 0 else {size - 1, size, size + 1}:
            found |= {_key(3, 0, rest[: other // 2]), _key(3, 1, rest[size - (other - other // 2) :])}
    return found


def by_parts(entries: DataFrame) -> DataFrame:
    """Each entry once for each hash that its open part can share, in the column ``part``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2_000):
                rows = batch.slice(low, 2_000)
                hashes, row = [], []
                for i, (word, role, at) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("word", "role", "at")))):
                    raw = word.encode("latin-1")
                    own = shared_parts(raw[at:] if at > 0 else raw[:-at], role)
                    hashes += own
                    row += [i] * len(own)
                taken = rows.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(hashes, pa.int64())], names=[*NAMES, "part"])

    return entries.select(*NAMES).mapInArrow(split, entries.select(*NAMES, F.lit(0).cast("long").alias("part")).schema)


def near_words(entries: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """word, other and other_n of all pairs one edit apart, some more than once.

    Pivots meet prefixes in the lists of the index; a pair is looked for where the pivot's word has
    the prefix that ends first, and verified. In lists of more than ``crowded`` prefixes only words
    whose open parts can become each other by an edit meet."""
    sizes = entries.groupBy("key").agg(F.sum("role").alias("n_prefix"), F.count("*").alias("n_all"))
    sizes = saved(sizes.filter((F.col("n_prefix") < F.col("n_all")) & (F.col("n_prefix") > 1)), "spelling-lists")
    full = sizes.filter(F.col("n_prefix") > crowded).select("key")
    light = entries.join(sizes.filter(F.col("n_prefix") <= crowded).select("key"), "key", "left_semi")
    parted = by_parts(entries.join(full, "key", "left_semi"))
    found = _met(light, ["key"]).unionByName(_met(parted, ["key", "part"]))
    both = F.explode(
        F.array(
            F.struct(F.col("word").alias("word"), F.col("other").alias("other"), F.col("other_n").alias("other_n")),
            F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")),
        )
    )
    return found.select(both.alias("p")).select("p.*")


def _met(entries: DataFrame, keys: list[str]) -> DataFrame:
    pivots = entries.filter(F.col("role") == 0).select(*keys, "word", "n", "last")
    prefixes = entries.filter(F.col("role") == 1).select(*keys, F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("last").alias("other_last"))
    near = (
        (F.col("last") <= F.col("other_last"))
        & (F.abs(F.length("word") - F.length("other")) <= 1)
        & (F.levenshtein("word", "other", 1) == 1)
    )
    return pivots.join(prefixes, keys).filter(near).select("word", "n", "other", "other_n")


def roots_of(forms: DataFrame) -> DataFrame:
    """word and root, the last form that is reached, for the words that have a form. Each round
    doubles the steps; a form is ten times as frequent, so chains are short."""
    now = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = saved(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        drop_saved(now)
        now = more
        if not now.filter("moved").head(1):
            return now.select("word", "root")


def spelling_variants(
    docs: DataFrame, length: int = LENGTH, fewest: int = OCCURRENCES, ratio: int = RATIO, crowded: int = CROWDED,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of A-Z (lower-cased), a-z and U+00C0 to U+00FF with at least ``length`` letters
    and ``fewest`` occurrences in all documents; one run in 31, by a checksum of its document's id and
    itself, has lost a letter. The form of a word is the most frequent word one edit away (of equal
    ones the smallest) if it occurs at least ``ratio`` times as often; root is where forms lead.

    Words are counted in the tasks, then summed. Bigrams are ordered by the number of words that
    hold them. The index has two entries for a word's pivots and at most thirty for its prefix; lists
    that many words share are split by their members' open parts, so no such list is compared whole.

    Null and empty texts have no words. Repeated rows count each; a null id counts as an empty one. An
    empty table gives no rows; other columns are not read. Long texts are cut in pieces, a single
    run of any length is kept whole."""
    if length < 2 * PIVOTS + 1:
        raise ValueError("words need five letters at least to have pivots")
    words = saved(word_counts(docs, length, fewest, id_col, text_col), "spelling-words")
    entries = saved(entries_of(words, bigram_counts(words)), "spelling-index")
    # One exchange: pairs of a word come together, are made distinct and then summed up.
    pairs = near_words(entries, crowded).repartition(F.col("word")).groupBy("word", "other").agg(F.first("other_n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    near = saved(pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "spelling-near")
    judged = words.join(near, "word", "left").withColumn("fits", -F.col("best.minus") >= ratio * F.col("n"))
    judged = saved(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("fits"), F.col("best.other")).alias("form"), F.when(F.col("fits"), -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = roots_of(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
