"""Packing of token streams into sequences by dynamic programming over allowed cuts."""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallyworks.llm.common import texts_of

LENGTH = 2_048
END = 1
#: Tokens that are packed together. Sequences do not reach over the end of such a segment.
SEGMENT = 1 << 20
#: Costs in tokens of padding: a cut after a sentence, a cut elsewhere, and each sequence.
SENTENCE_CUT, HARD_CUT, EACH = 2, 48, 4
#: Without a boundary for so many tokens, cuts are allowed there; near a segment's end every so many.
GAP, FINE = 512, 64

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids as the tokenizer file gives them, special tokens not added.

    The file is a byte-level BPE whose ids follow the order of its merges, so the ranks read from
    it give the same ids through a faster library; texts that hold a special token's string go
    through the tokenizer itself."""

    def __init__(self, path: str):
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        self.special = [t["content"] for t in content["added_tokens"]]
        letters = _byte_letters()
        vocab = content["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in self.special}
        self.fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path)
        size = max(ranks.values()) + 2
        self.ends_sentence = np.zeros(size + 1, bool)
        for token, i in ranks.items():
            self.ends_sentence[i] = token[-1:] in b".!?\n" and bool(token)
        self.ends_sentence[END] = False

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
    the others counted on from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def padding(size: int, length: int = LENGTH) -> int:
    return 0 if size & (size - 1) == 0 else length - size


def cut_places(sentence_ends: np.ndarray, doc_ends: np.ndarray, total: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts in order, from 0 to ``total``, with their costs."""
    cost = np.full(total + 1, -1, np.int32)
    fine = min(FINE, length)
    cost[np.arange(max(0, total - 2 * length) // fine * fine + total % fine, total + 1, fine)] = HARD_CUT
    cost[sentence_ends] = SENTENCE_CUT
    cost[doc_ends] = 0
    cost[0] = cost[total] = 0
    places = np.flatnonzero(cost >= 0)
    gap = min(GAP, length)
    wide = np.flatnonzero(np.diff(places) > gap)
    for at in wide:
        cost[np.arange(places[at] + gap, places[at + 1], gap)] = HARD_CUT
    if len(wide):
        places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int = LENGTH) -> list[int]:
    """The cuts (0 and the end among them) with the least padding plus cut costs, no sequence being
    longer than ``length``. Neighbouring places are at most ``length`` apart.

    ``best[i] = min over j of best[j] + EACH + padding + costs[i]``. The padding is linear in the
    place, so the best ``j`` of the window is the head of a queue whose ``best[j] + place[j]`` rises;
    sequences of a power of two are unpadded and looked up at their one place."""
    exact = []
    power = length // 2
    while power >= min(FINE, length // 2 or 1) and power > 0:
        at = np.searchsorted(places, places - power)
        hit = (places >= power) & (places[np.minimum(at, len(places) - 1)] == places - power)
        exact.append(np.where(hit, at, -1).tolist())
        power //= 2
    spot, cost = places.tolist(), costs.tolist()
    best, back = [0] * len(spot), [0] * len(spot)
    queue: deque[int] = deque([0])
    for i in range(1, len(spot)):
        here = spot[i]
        while spot[queue[0]] < here - length:
            queue.popleft()
        j = queue[0]
        low = best[j] + spot[j] + (length - here)
        for jumps in exact:
            k = jumps[i]
            if k >= 0 and best[k] < low:
                low, j = best[k], k
        best[i], back[i] = low + EACH + cost[i], j
        key = best[i] + here
        while queue and best[queue[-1]] + spot[queue[-1]] >= key:
            queue.pop()
        queue.append(i)
    cuts, i = [spot[-1]], len(spot) - 1
    while i:
        i = back[i]
        cuts.append(spot[i])
    return cuts[::-1]


def pack(tokens: list[np.ndarray], ends_sentence: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Pieces of consecutive documents: doc (its number), start, length, crc, doc_tokens, sequence
    and offset."""
    stream = np.concatenate(tokens)
    sizes = np.array([len(t) for t in tokens])
    doc_ends = np.cumsum(sizes)
    doc_starts = doc_ends - sizes
    sentences = np.flatnonzero(ends_sentence[stream]) + 1
    cuts = np.array(best_cuts(*cut_places(sentences, doc_ends, len(stream), length), length))
    starts = np.union1d(doc_starts, cuts[:-1])
    ends = np.append(starts[1:], len(stream))
    doc = np.searchsorted(doc_ends, starts, "right")
    sequence = np.searchsorted(cuts, starts, "right") - 1
    raw = memoryview(stream.astype("<u4").tobytes())
    return {
        "doc": doc,
        "start": starts - doc_starts[doc],
        "length": ends - starts,
        "crc": np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], np.int64),
        "doc_tokens": sizes[doc],
        "sequence": sequence,
        "offset": starts - cuts[sequence],
    }


def packed(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, segment: int = SEGMENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids end with id 1. Documents keep their order in the table and are packed
    inside their input split, in segments of about ``segment`` tokens, so nothing is shuffled and
    a task holds one segment. Sequences are cut at the ends of documents and sentences where that
    costs less padding than it saves, elsewhere where it must be.

    A null or empty text is the one id 1; repeated rows are packed each; a null id stays null; an
    empty table gives no rows; other columns are not read. Very long texts are cut anywhere that
    a boundary allows. ``sequence_id`` is unique, not dense."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        end = np.array([END], np.uint32)
        number = TaskContext.get().partitionId() << 33
        ids, tokens, held = [], [], 0

        def flush():
            nonlocal number
            got = pack(tokens, encoder.ends_sentence, length)
            columns = [pa.array(ids, pa.int64()).take(pa.array(got["doc"]))]
            got["sequence"] = got["sequence"] + number
            number = int(got["sequence"][-1]) + 1
            columns += [pa.array(got[k].astype(np.int64)) for k in ("start", "length", "crc", "doc_tokens", "sequence", "offset")]
            return pa.RecordBatch.from_arrays(columns, names=NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.concatenate([encoder.ids(text.as_py()), end])
                ids.append(doc_id)
                tokens.append(own)
                held += len(own)
                if held >= segment:
                    yield flush()
                    ids, tokens, held = [], [], 0
        if tokens:
            yield flush()

    return texts_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)


NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
