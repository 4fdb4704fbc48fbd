"""BPE encoding and decoding: greedy longest matches are proposed, every adjacent pair is checked, and
only words with a pair that cannot stand are merged rule by rule."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm.common import texts_of
from tallyworks.llm.packing import _byte_letters

#: Symbols are bytes; the last one of a word is counted on from 256.
LAST = 256
SYMBOLS = 512
#: Characters of a text that are taken at a time (a piece ends before white space).
PIECE = 1 << 20
#: Words that a task remembers, and the longest of them. All are forgotten at once when there are more.
KNOWN, REMEMBER = 500_000, 40
#: Bytes of a word up to which words are merged together, one rule of each at a time.
TOGETHER = 64
#: A rank that no rule has.
NEVER = np.int32(2**31 - 1)

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^{SPACE}a-z0-9]+")
#: The same for texts of Latin letters and common signs, all letters and numbers of which are named here.
LATIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    rf"|[^{SPACE}a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-\u024f]+"
)
BEYOND_LATIN = re.compile(r"[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
ALL_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
#: Letters and marks on whose classes and lower case all Unicode versions in use agree; texts with
#: others are cut into words by the library's own normalizer and pattern.
UNUSUAL = re.compile(
    r"[^\x00-ͷ΄-ԯḀ-ỿ -⁤₠-₿℀-↋　-ヾ一-龥가-힣]"
)
BREAK = re.compile(f"[{SPACE}]")


class Words:
    """Texts to words, as the tokenizer file's normalizer and pattern cut them."""

    def __init__(self, cutting: str):
        whole = Tokenizer.from_str(cutting)
        self.normal, self.cutter = whole.normalizer, whole.pre_tokenizer
        self.letters = _byte_letters()

    def cut(self, text: str) -> list[str]:
        if text.isascii():
            return WORDS.findall(text.lower())
        if UNUSUAL.search(text):
            return [self._plain(w) for w, _ in self.cutter.pre_tokenize_str(self.normal.normalize_str(text))]
        # Letter by letter: no rule for a sigma that ends a word.
        lower = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (ALL_WORDS if BEYOND_LATIN.search(lower) else LATIN_WORDS).findall(lower)

    def _plain(self, word: str) -> str:
        return bytes(self.letters[c] for c in word).decode("utf-8")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Parts of about ``size`` characters that end before white space, over which no word reaches."""
    low = 0
    while len(text) - low > size:
        at = BREAK.search(text, low + size)
        if at is None:
            break
        yield text[low : at.start()]
        low = at.start()
    yield text[low:]


def vocabulary(content: str) -> dict:
    """What tasks need of a tokenizer file, of fixed size: token names, base tokens, special tokens, how
    each token is made (``left``, ``right``, rank ``made``), the rules as sorted pairs, and the file
    without its model. The tree of tokens to propose is added by ``Tables.grow``."""
    held = json.loads(content)
    model, letters = held["model"], _byte_letters()
    end, vocab = model["end_of_word_suffix"], model["vocab"]
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    names = [""] * size
    for name, i in [*vocab.items(), *special.items()]:
        names[i] = name
    base = np.zeros(SYMBOLS, np.int32)
    for letter, byte in letters.items():
        base[byte], base[byte + LAST] = vocab[letter], vocab[letter + end]
    first, second, joined = (
        np.array([f(a, b) for a, b in model["merges"]], np.int64)
        for f in (lambda a, b: vocab[a], lambda a, b: vocab[b], lambda a, b: vocab[a + b])
    )
    left, right, made = np.zeros(size, np.int32), np.zeros(size, np.int32), np.full(size, -1, np.int32)
    left[joined], right[joined], made[joined] = first, second, np.arange(len(joined))
    if (np.maximum(made[first], made[second]) >= np.arange(len(joined))).any():
        raise ValueError("a merge rule comes before the rules of its parts")
    keys = first * size + second
    order = np.argsort(keys)
    own = dict(held, model=dict(model, vocab={n: i for n, i in vocab.items() if made[i] < 0}, merges=[]))
    tables = Tables(
        {
            "names": names, "special": special, "base": base, "left": left, "right": right, "made": made,
            "pair_keys": keys[order], "pair_ranks": order.astype(np.int32), "joined": joined,
            "cutting": json.dumps(own | {"added_tokens": []}),
        }
    )
    tables.grow(vocab, letters, end)
    return tables.parts


class Lookup:
    """Whole numbers to their places in ``keys``, by multiplication into a table at most half full."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, -1)
        bits = int(2 * len(keys)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, len(keys), np.int64)
        rows, at = np.arange(len(keys)), self._slot(keys)
        while len(rows):
            free = self.slots[at] == len(keys)
            self.slots[at[free]] = rows[free]
            lost = self.slots[at] != rows
            rows, at = rows[lost], (at[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each number, or the number of keys where it is none of them."""
        slot = self._slot(wanted)
        place = self.slots[slot]
        found = self.keys[place]
        open_ = np.flatnonzero((found != wanted) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            place[open_] = self.slots[slot[open_]]
            found = self.keys[place[open_]]
            open_ = open_[(found != wanted[open_]) & (found >= 0)]
        return place


class Tables:
    """Tokens as a tree of symbols, merge rules as sorted pairs, and how each token is made."""

    def __init__(self, parts: dict):
        self.parts = parts
        self.__dict__.update(parts)
        self.size = len(self.names)
        self.digits = [str(i) for i in range(self.size)]
        self._rules: dict[tuple[int, int], int] = {}
        self.pair_at, self.rank_at = Lookup(self.pair_keys), np.append(self.pair_ranks, NEVER)
        if "edges" in parts:
            self.edge_at, self.child_at = Lookup(self.edges), np.append(self.children, 0)

    def grow(self, vocab: dict[str, int], letters: dict[str, int], end: str) -> None:
        """The tree of the tokens that merging their own symbols gives; others are never proposed."""
        merged = np.argsort(self.made, kind="stable")
        merged = merged[self.made[merged] >= 0]
        stands = self.apart(self.left[merged], self.right[merged], self.made[merged])
        sound = (self.made < 0).tolist()
        for token, a, b, ok in zip(merged.tolist(), self.left[merged].tolist(), self.right[merged].tolist(), stands.tolist()):
            sound[token] = ok and sound[a] and sound[b]
        children: dict[int, int] = {}
        accepts = [-1]
        for name, token in vocab.items():
            if not sound[token]:
                continue
            closed = name.endswith(end) and name != end
            symbols = [letters[c] for c in (name[: -len(end)] if closed else name)]
            if closed:
                symbols[-1] += LAST
            node = 0
            for s in symbols:
                key = node * SYMBOLS + s
                if key not in children:
                    children[key] = len(accepts)
                    accepts.append(-1)
                node = children[key]
            accepts[node] = token
        edges = np.array(sorted(children), np.int64)
        tree = {"edges": edges, "children": np.array([children[k] for k in edges.tolist()], np.int64), "accepts": np.array(accepts, np.int32)}
        self.parts |= tree
        self.__dict__.update(tree)

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the symbols of a and b keeps the place between them free (until the rule of
        rank ``before``). The right edge of a and the left edge of b are undone together, the last
        made first; a rule over the place fires if both its parts stand there when its turn comes."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        gone_a = np.full(len(a), NEVER) if before is None else before.astype(np.int32)
        gone_b = gone_a - np.int32(before is not None)  # at equal rank the merge further left comes first
        ok, rows = np.ones(len(a), bool), np.arange(len(a))
        while len(rows):
            rank = self.rank_at[self.pair_at(a * self.size + b)]
            fires = (rank < gone_a) & (rank <= gone_b) & (rank < NEVER)
            ok[rows[fires]] = False
            on = ~fires & ((self.made[a] >= 0) | (self.made[b] >= 0))
            rows, a, b, gone_a, gone_b = rows[on], a[on], b[on], gone_a[on], gone_b[on]
            made_a, made_b = self.made[a], self.made[b]
            undo_a = made_a > made_b
            gone_a, gone_b = np.where(undo_a, made_a, gone_a), np.where(undo_a, gone_b, made_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def propose(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at each place, and the place after it."""
        token, after = self.base[symbols], np.arange(1, len(symbols) + 1)
        rows, node = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
        depth = 0
        while len(rows):
            child = self.child_at[self.edge_at(node * SYMBOLS + symbols[rows + depth])]
            known = child > 0
            rows, node = rows[known], child[known]
            depth += 1
            found = self.accepts[node]
            hit = found >= 0
            token[rows[hit]], after[rows[hit]] = found[hit], rows[hit] + depth
            on = rows + depth < len(symbols)
            rows, node = rows[on], node[on]
        return token, after

    def merged_long(self, symbols: list[int]) -> list[int]:
        """Token ids of one word by the merge rules: the lowest rank first, of equal ones the leftmost."""
        if not self._rules:
            a, b = np.divmod(self.pair_keys, self.size)
            self._rules = dict(zip(zip(a.tolist(), b.tolist()), self.pair_ranks.tolist()))
        rules, joined = self._rules, self.joined.tolist()
        tokens = self.base[symbols].tolist()
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rules[pair], i) for i in range(n - 1) if (pair := (tokens[i], tokens[i + 1])) in rules]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i] if tokens[i] >= 0 else n
            if j >= n or rules.get((tokens[i], tokens[j])) != rank:
                continue
            tokens[i], tokens[j] = joined[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rules.get((tokens[i], tokens[k]))) is not None:
                    heapq.heappush(queue, (r, i))
            if (h := before[i]) >= 0 and (r := rules.get((tokens[h], tokens[i]))) is not None:
                heapq.heappush(queue, (r, h))
        return [t for t in tokens if t >= 0]

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Many words by the merge rules, one rule of each word at a time: the token at its first
        symbol, -1 elsewhere."""
        out = np.full(len(symbols), -1, np.int64)
        word, place, tokens = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(symbols)), self.base[symbols].astype(np.int64)
        while len(word):
            inside = np.append(word[1:] == word[:-1], False)
            rank = np.where(inside, self.rank_at[self.pair_at(tokens * self.size + np.append(tokens[1:], 0))], NEVER)
            starts = np.flatnonzero(np.append(True, ~inside[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            going = best < NEVER
            if not going.all():
                done = ~going
                out[place[done]] = tokens[done]
            hit = np.flatnonzero((rank == best) & going)
            # Of hits side by side, as in a run of one letter, every other one from the left.
            beside = np.flatnonzero(np.diff(hit) == 1)
            if len(beside):
                new = np.append(True, np.diff(hit) > 1)
                run = np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            tokens[hit] = self.joined[rank[hit]]
            going[hit + 1] = False
            word, place, tokens = word[going], place[going], tokens[going]
        return out

    def encode(self, words: list[str]) -> tuple[list[int], list[int], int]:
        """Token ids of the words in a row, where each word ends in them, and how many were merged."""
        raw = [w.encode("utf-8") for w in words]
        ends = np.cumsum([len(r) for r in raw])
        starts = np.append(0, ends[:-1])
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        symbols[ends - 1] += LAST
        token, after = self.propose(symbols)
        # All words step from token to token together; the rest of very long ones alone.
        taken, place, last = np.zeros(len(symbols) + 1, bool), starts, ends
        for _ in range(TOGETHER):
            taken[place] = True
            place = after[place]
            on = place < last
            place, last = place[on], last[on]
        for low, end in zip(place.tolist(), last.tolist()):
            while low < end:
                taken[low] = True
                low = int(after[low])
        ids = np.where(taken[:-1], token, -1).astype(np.int64)
        line, stops = ids[taken[:-1]], np.cumsum(taken[:-1])[ends - 1]
        pairs, which = np.unique(line[:-1] * self.size + line[1:], return_inverse=True)
        fine = self.apart(pairs // self.size, pairs % self.size)[which] if len(pairs) else np.zeros(0, bool)
        fine[stops[:-1] - 1] = True  # between two words
        wrong = np.unique(np.searchsorted(stops, np.flatnonzero(~fine), "right"))
        sizes = ends[wrong] - starts[wrong]
        short = wrong[sizes <= TOGETHER]
        if len(short):
            n = ends[short] - starts[short]
            places = np.repeat(starts[short] - np.cumsum(n) + n, n) + np.arange(n.sum())
            ids[places] = self.merged(symbols[places], n)
        for w in wrong[sizes > TOGETHER].tolist():
            own = self.merged_long(symbols[starts[w] : ends[w]].tolist())
            ids[starts[w] : ends[w]] = -1
            ids[starts[w] : starts[w] + len(own)] = own
        held = ids >= 0
        return ids[held].tolist(), np.cumsum(held)[ends - 1].tolist(), len(wrong)


class Known(dict):
    """Words and their entries: ids and tokens, joined. An unknown word gets an entry to be filled."""

    def __init__(self):
        super().__init__()
        self.new: list[tuple[str, list]] = []

    def __missing__(self, word: str) -> list:
        entry = self[word] = ["", ""]
        self.new.append((word, entry))
        return entry


class Encoder:
    """Ids and decoded tokens of texts, with the words of a task remembered."""

    def __init__(self, parts: dict):
        self.tables, self.words = Tables(parts), Words(parts["cutting"])
        self.known = Known()
        self.parts = re.compile("(" + "|".join(map(re.escape, self.tables.special)) + ")")
        self.open: list | None = None

    def fill(self) -> None:
        """Encode the new words together. Long ones are not remembered; all are forgotten above the bound."""
        known, new = self.known, self.known.new
        if not new:
            return
        flat, ends, _ = self.tables.encode([w for w, _ in new])
        digits, names = list(map(self.tables.digits.__getitem__, flat)), list(map(self.tables.names.__getitem__, flat))
        join, low = " ".join, 0
        for (word, entry), high in zip(new, ends):
            if high == low + 1:
                entry[0], entry[1] = digits[low], names[low]
            else:
                entry[0], entry[1] = join(digits[low:high]), join(names[low:high])
                if len(word) > REMEMBER:
                    del known[word]
            low = high
        new.clear()
        if len(known) > KNOWN:
            known.clear()

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of the text, and whether a part is a special token, found before all else."""
        if "<|" not in text:
            yield text, False
            return
        for part in self.parts.split(text):
            if part:
                yield part, part in self.tables.special

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """n_tokens and the two digests of each text, read in pieces."""
        jobs, held, entry_of = [], 0, self.known.__getitem__
        for text in texts:
            for piece in pieces(text):
                for part, special in self.segments(piece):
                    if special:
                        jobs.append([[self.tables.digits[self.tables.special[part]], part]])
                    else:
                        jobs.append(list(map(entry_of, self.words.cut(part))))
                held += len(piece)
                if held >= PIECE:
                    yield from self._flush(jobs)
                    jobs, held = [], 0
            jobs.append(None)
        yield from self._flush(jobs)

    def _flush(self, jobs: list) -> Iterator[tuple[int, str, str]]:
        self.fill()
        for entries in jobs:
            state = self.open = self.open or [0, hashlib.sha256(), hashlib.sha256()]
            if entries is None:
                yield state[0], state[1].hexdigest(), state[2].hexdigest()
                self.open = None
            elif entries:
                ids, gap = " ".join([e[0] for e in entries]), " " if state[0] else ""
                state[0] += ids.count(" ") + 1
                state[1].update((gap + ids).encode())
                state[2].update((gap + " ".join([e[1] for e in entries])).encode())


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by a space)
    and decoded_sha256 (of the decoded text).

    The tokenizer file is a BPE of words with word ends, without a decoder: decoding joins the tokens
    by a space. Its tables, of fixed size, are sent to the tasks once. A task cuts texts into words, remembers words
    up to a bound, and proposes tokens for the new ones of a piece together. If no adjacent pair of a
    word would merge otherwise, the proposal is what merging gives; other words are merged.

    Null and empty texts have no tokens and the digest of nothing. Repeated rows and null ids stay,
    an empty table gives no rows, other columns are not read. Long texts are read in pieces that end
    before white space; a single word of any length is kept whole in its task."""
    content = docs.sparkSession.sparkContext.broadcast(vocabulary(Path(tokenizer).read_text(encoding="utf-8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                rows = batch.slice(low, 512)
                n, ids, decoded = zip(*encoder.digests(rows.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
