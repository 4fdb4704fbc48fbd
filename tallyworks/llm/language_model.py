"""Language-model scores: a gated recurrent network with a class-factored softmax over frequent
words, corpus counts for the others, and the add-one unigram score beside it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse, groupby
from math import prod

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import crc_mod, saved

MODULUS, HELD_OUT = 7, 2
#: The network starts from at most so many documents; of a longer one a passage of so many characters is taken.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_TOKENS = 500, 50_000, 150_000
#: It then learns from all of them: lanes, tokens laid on them at a time, rate, and numbers in a row of a task's weights.
PASS_LANES, PASS_TOKENS, PASS_RATE, BLOCK = 1_024, 1 << 19, 0.008, 1_024
#: Words with outputs of their own, the most frequent of all training documents; their classes; sizes of the network.
HEAD, CLASSES, EMBED, HIDDEN = 1_500, 40, 16, 24
EPOCHS, LANES, WINDOW, RATE = 4, 48, 24, 0.008
#: Documents scored side by side, and tokens of a window over all of them.
GROUP, CELLS = 8_192, 32_768
#: Fewest buckets; bytes of text to a bucket of words, rows to a bucket of rows; packed sums added at a time.
BUCKETS, WORD_BYTES, ROWS, ADDED = 8, 16 << 20, 20_000, 1 << 21
LOG10 = float(np.log(10.0))

END = 0  # its number; the tail class comes after the head words


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


class Vocabulary:
    """Numbers of the head words: 0 is the end of a text, the last number any other word. Words of
    a class follow each other."""

    def __init__(self, counts: Counter, size: int = HEAD, classes: int = CLASSES):
        ranked = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]
        self.number = {w: i + 1 for i, w in enumerate(ranked)}
        self.tail = len(ranked) + 1
        # Classes of equal shares of the square roots of the counts: frequent words are in small ones.
        weight = np.sqrt([1.0, *(counts[w] for w in ranked)])
        share = np.cumsum(weight) / weight.sum()
        word_class = np.minimum((share - share[0]) * classes, classes - 1).astype(np.int64)
        _, word_class = np.unique(word_class, return_inverse=True)
        self.word_class = np.append(word_class, word_class[-1] + 1)
        self.first = np.searchsorted(self.word_class, np.arange(self.word_class[-1] + 2))

    def ids(self, words: list[bytes]) -> np.ndarray:
        get, tail = self.number.get, self.tail
        return np.array([get(w, tail) for w in words] + [END], np.int32)


def sigmoid(x):
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Space(dict):
    """Large arrays that are used again: new ones take longer than what is done in them."""

    def __call__(self, name: str, *shape: int, like: np.ndarray) -> np.ndarray:
        size = prod(shape)
        if name not in self or self[name].size < size or self[name].dtype != like.dtype:
            self[name] = np.empty(size, like.dtype)
        return self[name][:size].reshape(shape)


class Network:
    """Gated recurrent units; inputs are the previous words."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 11):
        rng = np.random.default_rng(seed)
        n, c = vocabulary.tail + 1, int(vocabulary.word_class[-1]) + 1
        scale = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        self.first = vocabulary.first
        self.word_class = vocabulary.word_class
        self.p = {
            "embed": rng.normal(0, 0.3, (n, EMBED)).astype(np.float32),
            "w": scale(EMBED, 3 * HIDDEN),
            "u": scale(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32),
            "wc": scale(HIDDEN, c),
            "bc": np.zeros(c, np.float32),
            "ww": rng.normal(0, 0.1, (n, HIDDEN)).astype(np.float32),
            "bw": np.zeros(n, np.float32),
        }

    def table(self) -> np.ndarray:
        """What each word adds to the gates."""
        return self.p["embed"] @ self.p["w"] + self.p["b"]

    def step(self, gates: np.ndarray, h: np.ndarray):
        """The next state, both gates, the candidate, and what this state adds to it."""
        u = h @ self.p["u"]
        zr = gates[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]
        sigmoid(zr)
        # The hyperbolic tangent by the sigmoid, whose powers of e are faster.
        n = zr[:, HIDDEN:] * u[:, 2 * HIDDEN :]
        n += gates[:, 2 * HIDDEN :]
        n *= 2
        sigmoid(n)
        n *= 2
        n -= 1
        out = h - n
        out *= zr[:, :HIDDEN]
        out += n
        return out, zr, n, u[:, 2 * HIDDEN :]

    def chances(self, flat: np.ndarray, target: np.ndarray, space: Space):
        """Of classes of several words: the positions in them by class, the chances of a class's words one
        after the other, where those of a position begin, the states of the positions, and of each class
        its rows, words and chances."""
        kind, wide = self.word_class[target], np.diff(self.first)
        count = np.bincount(kind, minlength=len(wide))
        order = np.argsort(kind.astype(np.int16), kind="stable")[np.repeat(wide > 1, count)]
        count[wide == 1] = 0
        width = np.repeat(wide, count)
        starts = np.cumsum(width) - width
        y = space("words", int(width.sum()), like=flat)
        here = np.take(flat, order, axis=0, out=space("here", len(order), HIDDEN, like=flat), mode="clip")
        parts, row, at = [], 0, 0
        for c in np.flatnonzero(count):
            low, high, rows = self.first[c], self.first[c + 1], slice(row, row + count[c])
            cells = y[at : at + count[c] * (high - low)].reshape(count[c], high - low)
            np.matmul(here[rows], self.p["ww"][low:high].T, out=cells)
            cells += self.p["bw"][low:high]
            parts.append((rows, low, high, cells))
            row, at = row + count[c], at + cells.size
        if len(y):
            if max(y.max(), -y.min()) > 60:
                y -= np.repeat(np.maximum.reduceat(y, starts), width)
            np.exp(y, out=y)
            y /= np.repeat(np.add.reduceat(y, starts), width)
        return order, y, starts, here, parts

    def of_classes(self, flat: np.ndarray, space: Space) -> np.ndarray:
        """The chances of all classes."""
        x = np.matmul(flat, self.p["wc"], out=space("classes", len(flat), len(self.p["bc"]), like=flat))
        x += self.p["bc"]
        if max(x.max(), -x.min()) > 60:
            x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
        return x

    def log_prob(self, h: np.ndarray, target: np.ndarray, space: Space | None = None) -> np.ndarray:
        """Natural log of the class's and of the word's probability inside it."""
        space = Space() if space is None else space
        out = np.log(np.maximum(self.of_classes(h, space)[np.arange(len(target)), self.word_class[target]], 1e-30))
        order, y, starts, _, _ = self.chances(h, target, space)
        out[order] += np.log(np.maximum(y[starts + target[order] - self.first[self.word_class[target[order]]]], 1e-30))
        return out

    def window(self, source: np.ndarray, target: np.ndarray, keep: np.ndarray, h: np.ndarray, space: Space | None = None):
        """Truncated backpropagation through one window (steps x lanes): the gradients, the state
        at its end, and the loss. ``keep`` is 0 where a text begins."""
        p, steps, lanes = self.p, *source.shape
        table, space = self.table(), Space() if space is None else space
        new = lambda name, parts: space(name, steps, lanes, parts * HIDDEN, like=table)
        gates = np.take(table, source, axis=0, out=new("gates", 3), mode="clip")
        states, before, n, un, zr = new("states", 1), new("before", 1), new("n", 1), new("un", 1), new("zr", 2)
        for t in range(steps):
            np.multiply(h, keep[t][:, None], out=before[t])
            h, zr[t], n[t], un[t] = self.step(gates[t], before[t])
            states[t] = h
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        flat, goal = states.reshape(-1, HIDDEN), target.ravel()
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        x, rows, kind = self.of_classes(flat, space), np.arange(len(goal)), self.word_class[goal]
        loss = -np.log(x[rows, kind] + 1e-12).sum()
        x[rows, kind] -= 1
        grad["wc"], grad["bc"] = flat.T @ x, np.ones(len(x), x.dtype) @ x
        back = np.matmul(x, p["wc"].T, out=space("back", len(flat), HIDDEN, like=table))
        order, y, starts, here, parts = self.chances(flat, goal, space)
        at = starts + goal[order] - self.first[kind[order]]
        loss -= np.log(y[at] + 1e-12).sum()
        y[at] -= 1
        inside = space("inside", len(order), HIDDEN, like=table)
        for picked, low, high, cells in parts:
            grad["ww"][low:high] = cells.T @ here[picked]
            grad["bw"][low:high] = np.ones(len(cells), cells.dtype) @ cells
            np.matmul(cells, p["ww"][low:high], out=inside[picked])
        back[order] += inside
        back = back.reshape(steps, lanes, HIDDEN)
        # What a change of the state is worth in each gate, of all steps at once.
        of_n, of_z, of_r, one_z = new("of_n", 1), new("of_z", 1), new("of_r", 1), new("one_z", 1)
        np.subtract(1, z, out=one_z)
        np.multiply(n, n, out=of_n)
        np.subtract(1, of_n, out=of_n)
        of_n *= one_z
        np.subtract(before, n, out=of_z)
        of_z *= z
        of_z *= one_z
        np.subtract(1, r, out=of_r)
        of_r *= r
        of_r *= un
        d_gates, d_state = new("d_gates", 3), new("d_state", 3)
        d, across = np.zeros((lanes, HIDDEN), gates.dtype), np.ascontiguousarray(p["u"].T)
        for t in reversed(range(steps)):
            d += back[t]
            here, state = d_gates[t], d_state[t]
            np.multiply(d, of_z[t], out=here[:, :HIDDEN])
            dn = np.multiply(d, of_n[t], out=here[:, 2 * HIDDEN :])
            np.multiply(dn, of_r[t], out=here[:, HIDDEN : 2 * HIDDEN])
            state[:, : 2 * HIDDEN] = here[:, : 2 * HIDDEN]
            np.multiply(dn, r[t], out=state[:, 2 * HIDDEN :])
            d *= z[t]
            d += state @ across
            d *= keep[t][:, None]
        grad["u"] = before.reshape(-1, HIDDEN).T @ d_state.reshape(-1, 3 * HIDDEN)
        d_flat, inputs = d_gates.reshape(-1, 3 * HIDDEN), source.ravel()
        grad["b"] = np.ones(len(d_flat), d_flat.dtype) @ d_flat
        # Positions of a word are added up before its vector and the weights are reached.
        order = np.argsort(inputs.astype(np.int16), kind="stable")
        cut = np.flatnonzero(np.diff(inputs[order], prepend=-1))
        word, ends = inputs[order][cut], np.append(cut[1:], len(order))
        often = ends - cut > len(order) // 8
        sums = np.empty((len(word), 3 * HIDDEN), gates.dtype)
        for i in np.flatnonzero(often):
            sums[i] = np.ones(ends[i] - cut[i], gates.dtype) @ d_flat[order[cut[i] : ends[i]]]
        rest = order[~np.repeat(often, ends - cut)]
        if len(rest):
            size = (ends - cut)[~often]
            rows = np.take(d_flat, rest, axis=0, out=space("rows", len(rest), 3 * HIDDEN, like=table), mode="clip")
            sums[~often] = np.add.reduceat(rows, np.cumsum(size) - size, axis=0)
        grad["w"] = p["embed"][word].T @ sums
        grad["embed"][word] = sums @ p["w"].T
        return grad, h, loss


class Descent:
    """Adam on a network's weights."""

    def __init__(self, network: Network):
        self.network, self.count, self.space = network, 0, Space()
        self.first = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in network.p.items()}

    def update(self, grad: dict[str, np.ndarray], size: int, rate: float) -> None:
        self.count += 1
        first, second, p = self.first, self.second, self.network.p
        for k, g in grad.items():
            g = np.clip(g / size * 8, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            step = first[k] / (1 - 0.9**self.count) / (np.sqrt(second[k] / (1 - 0.99**self.count)) + 1e-6)
            p[k] = p[k] - (rate * step).astype(np.float32)

    def learn(self, stream: np.ndarray, lanes: int, rate: float, steps: int | None = None) -> np.ndarray:
        """Learn from a stream of texts on lanes, in windows (of ``steps``) that hand their states on. What is
        left, less than a token a lane, is returned."""
        length, steps = len(stream) // lanes, steps or WINDOW
        target = stream[: lanes * length].reshape(lanes, length).T
        source = np.vstack([np.full((1, lanes), END, np.int32), target[:-1]])
        keep = (source != END).astype(np.float32)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for low in range(0, length, steps):
            cut = slice(low, low + steps)
            grad, h, _ = self.network.window(source[cut], target[cut], keep[cut], h, self.space)
            self.update(grad, target[cut].size, rate)
        return stream[lanes * length :]


def fit(texts: list[list[bytes]], seed: int = 11, counts: Counter | None = None) -> tuple[Vocabulary, Network]:
    """Vocabulary from ``counts`` (else those of the texts), network from these texts. Texts are laid end to end on lanes; the state
    is carried from window to window and reset where a text begins."""
    if counts is None:
        counts = Counter(w for words in texts for w in words)
    vocabulary = Vocabulary(counts)
    network = Network(vocabulary, seed)
    if not texts:
        return vocabulary, network
    rng, descent = np.random.default_rng(seed), Descent(network)
    coded = [vocabulary.ids(words) for words in texts]
    for epoch in range(EPOCHS):
        stream = np.concatenate([coded[i] for i in rng.permutation(len(coded))])
        descent.learn(stream, max(1, min(LANES, len(stream) // WINDOW)), RATE * (0.5**epoch) ** 0.7)
    return vocabulary, network


def learn_all(texts: DataFrame, vocabulary: Vocabulary, network: Network) -> Network:
    """The network after one pass over all training rows, whole texts, from where it is. Each task learns
    from its rows; the weights are averaged over the tasks by their tokens, in parts that are added up
    where they meet, so the driver gets them once, whatever the number of tasks."""
    names = list(network.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.__dict__ |= network.__dict__ | {"p": dict(network.p)}
        descent = Descent(own)
        held, size, tokens = [], 0, 0

        def learn(last: bool):
            stream = np.concatenate(held)
            rest = descent.learn(stream, max(1, min(PASS_LANES, len(stream) // WINDOW)), PASS_RATE)
            if last and len(rest):  # few tokens, so a small step
                descent.learn(rest, 1, PASS_RATE * (len(rest) / (PASS_LANES * WINDOW)) ** 0.5, len(rest))
            return rest

        for (part,) in _rows(batches):
            for text in part:
                held.append(vocabulary.ids(words_of(text)))
                size += len(held[-1])
                tokens += len(held[-1])
                if size >= PASS_TOKENS:
                    held = [learn(False)]
                    size = len(held[0])
        if size:
            learn(True)
        if tokens:
            weights = np.concatenate([own.p[k].ravel() for k in names])
            parts = range(0, len(weights), BLOCK)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([task] * len(parts), pa.int32()), pa.array([float(tokens)] * len(parts)),
                 pa.array([weights[low : low + BLOCK] for low in parts], pa.list_(pa.float32()))],
                names=["block", "task", "tokens", "weights"],
            )

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b.column(0)[r].as_py(), b.column(2)[r].as_py(), b.column(3)[r].values.to_numpy(zero_copy_only=False)) for b in batches for r in range(b.num_rows))
        for block, run in groupby(rows, key=lambda row: row[0]):
            total, tokens = 0.0, 0.0
            for _, n, weights in run:
                total, tokens = total + n * weights.astype(np.float64), tokens + n
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total / tokens], pa.list_(pa.float64()))], names=["block", "weights"])

    learnt = texts.filter(~F.col("held_out")).select("text").mapInArrow(run, "block int, task int, tokens double, weights array<float>")
    # Tasks are added in one order, so that a second run gives the same weights.
    dealt = learnt.repartition("block").sortWithinPartitions("block", "task")
    parts = sorted(dealt.mapInArrow(average, "block int, weights array<double>").collect())
    if parts:
        weights, at = np.concatenate([np.array(p["weights"], np.float32) for p in parts]), 0
        for k in names:
            shape, size = network.p[k].shape, network.p[k].size
            network.p[k] = weights[at : at + size].reshape(shape)
            at += size
    return network


def score_group(network: Network, table: np.ndarray, coded: list[np.ndarray], space: Space | None = None) -> np.ndarray:
    """Log10 probabilities of whole texts (tail words as their class), side by side, in windows that
    hand their states on; a text leaves when it ends."""
    sizes = np.array([len(c) for c in coded])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    flat = np.concatenate([coded[i] for i in order])
    starts = np.cumsum(sizes) - sizes
    total = np.zeros(len(coded))
    h = np.zeros((len(coded), HIDDEN), np.float32)
    at, space = 0, Space() if space is None else space
    while at < sizes[0]:
        active = int(np.searchsorted(-sizes, -at, "left"))
        steps = int(min(max(8, CELLS // active), sizes[0] - at))
        place = at + np.arange(steps)
        inside = place[:, None] < sizes[None, :active]
        index = np.minimum(starts[None, :active] + place[:, None], len(flat) - 1)
        target = flat[index]
        source = np.where(place[:, None] > 0, flat[np.maximum(index - 1, 0)], END)
        now = h[:active]
        states = space("states", steps, active, HIDDEN, like=table)
        for t in range(steps):
            now = network.step(table[source[t]], now)[0]
            states[t] = now
        h[:active] = now
        got = network.log_prob(states[inside], target[inside], space)
        total[:active] += np.bincount(np.nonzero(inside)[1], got, minlength=active)
        at += steps
    out = np.zeros(len(coded))
    out[order] = total / LOG10
    return out


def row_key(doc_id: int | None, text: str) -> int:
    value = xxhash.xxh64_intdigest(b"%d:" % (doc_id or 0) + text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _rows(batches: Iterator[pa.RecordBatch], size: int = 512):
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            yield [c.to_pylist() for c in batch.slice(low, size).columns]


def head_words(texts: DataFrame, size: int) -> Counter:
    """The most frequent words of all training rows, equal counts by word, and their counts. Tasks
    add up their words before they are dealt; the driver gets ``size`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

        for (part,) in _rows(batches):
            for text in part:
                sums.update(words_of(text))
                if len(sums) > 200_000:
                    yield flush()
                    sums.clear()
        if sums:
            yield flush()

    found = texts.filter(~F.col("held_out")).select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Counter({bytes(word): n for word, n in found.orderBy(F.desc("n"), "word").limit(size).collect()})


def head_scores(texts: DataFrame, model, counts: np.ndarray) -> DataFrame:
    """Of each row: its key, counts of tokens, and the parts of both scores that head words make."""
    logs = np.append(np.log10(counts + 1.0), 0.0)
    known = np.append(counts > 0, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network = model
        table, space = network.table(), Space()
        held: list[tuple] = []

        def flush():
            coded = [h[3] for h in held]
            score = score_group(network, table, coded, space)
            columns = [
                pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held]), pa.array([h[2] for h in held]),
                pa.array([len(c) for c in coded], pa.int64()), pa.array([int((c == vocabulary.tail).sum()) for c in coded], pa.int64()),
                pa.array([int(known[c].sum()) for c in coded], pa.int64()), pa.array([float(logs[c].sum()) for c in coded]), pa.array(score),
            ]
            return pa.RecordBatch.from_arrays(columns, names=NAMES)

        for ids, folds, part in _rows(batches):
            for doc_id, fold, text in zip(ids, folds, part):
                held.append((doc_id, row_key(doc_id, text), fold, vocabulary.ids(words_of(text))))
                if len(held) == GROUP:
                    yield flush()
                    held = []
        if held:
            yield flush()

    return texts.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, key long, held_out boolean, n_tokens long, n_tail long, known long, head_log double, model_log double"
    )


NAMES = "doc_id key held_out n_tokens n_tail known head_log model_log".split()


def tail_entries(texts: DataFrame, number: dict[bytes, int], buckets: int) -> DataFrame:
    """Every other word of every row with how often it is there, in arrays for each bucket of word
    hashes: word, row key, times, and whether the row is a training row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[bytes, int] = {}
        for batch in _rows(batches, 1_024):
            word, times, rows = [], [], []
            for doc_id, fold, text in zip(*batch):
                if len(hashes) > 200_000:
                    hashes.clear()
                tally = Counter(filterfalse(number.__contains__, words_of(text)))
                for w in filterfalse(hashes.__contains__, tally):
                    hashes[w] = xxhash.xxh64_intdigest(w)
                word += [hashes[w] for w in tally]
                times += tally.values()
                rows.append((row_key(doc_id, text), not fold, len(tally)))
            if not word:
                continue
            row, learn, size = (np.array(c) for c in zip(*rows))
            key, learn = np.repeat(row, size), np.repeat(learn.astype(np.int8), size)
            words = np.array(word, np.uint64)
            bucket = (words >> np.uint64(40)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            offsets = pa.array(np.append(cut, len(order)).astype(np.int32))
            lists = [words.view(np.int64), key, np.array(times, np.int32), learn]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[order][cut].astype(np.int32)), *[pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in lists]],
                names=["bucket", "word", "key", "times", "learn"],
            )

    return texts.select("doc_id", "held_out", "text").mapInArrow(
        run, "bucket int, word array<long>, key array<long>, times array<int>, learn array<tinyint>"
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[list[np.ndarray]]]]:
    """The rows of each value of the first column, which is sorted, as arrays."""
    rows = ([batch.column(0)[r].as_py(), [c[r].values.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]] for batch in batches for r in range(batch.num_rows))
    for bucket, run in groupby(rows, key=lambda row: row[0]):
        yield bucket, (row[1] for row in run)


def tail_sums(entries: DataFrame, row_buckets: int) -> DataFrame:
    """A word's entries meet in its bucket, which counts it in the training rows and gives each row
    (key) the sum of log10(count + 1) and its known tokens, packed in one row for each bucket of keys. A
    row with a null bucket carries the word bucket's training tokens (total) and distinct training
    words (known)."""
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _runs(batches):
            word, key, times, learn = (np.concatenate(c) for c in zip(*held))
            _, kind = np.unique(word, return_inverse=True)
            count = np.bincount(kind, times * learn)
            rows, row = np.unique(key, return_inverse=True)
            logs = np.bincount(row, times * np.log10(count[kind] + 1.0))
            known = np.bincount(row, times * (count[kind] > 0)).astype(np.int64)
            part = (rows.view(np.uint64) % np.uint64(row_buckets)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cut = np.flatnonzero(np.diff(part[order], prepend=-1))
            ends = np.append(np.append(cut, len(order)), len(order) + 1).astype(np.int32)
            lists = [np.append(rows[order], 0), np.append(logs[order], count.sum()), np.append(known[order], (count > 0).sum())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(part[order][cut], 0).astype(np.int32), mask=np.arange(len(cut) + 1) == len(cut)),
                 *[pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in lists]],
                names=["rows", "key", "total", "known"],
            )

    return dealt.mapInArrow(run, "rows int, key array<long>, total array<double>, known array<long>")


def row_sums(sums: DataFrame) -> DataFrame:
    """key, total and known of every row, added up over the word buckets. A task holds one bucket of
    keys, and of its packed rows a bounded number before they are added."""
    dealt = sums.filter(F.col("rows").isNotNull()).repartition("rows").sortWithinPartitions("rows")

    def add(held):
        key, total, known = (np.concatenate(c) for c in zip(*held))
        keys, row = np.unique(key, return_inverse=True)
        return [keys, np.bincount(row, total), np.bincount(row, known).astype(np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _runs(batches):
            held, size = [], 0
            for part in parts:
                held.append(part)
                size += len(part[0])
                if size > ADDED:
                    held = [add(held)]
                    size = 0
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in add(held)], names=["key", "total", "known"])

    return dealt.mapInArrow(run, "key long, total double, known long")


def sample_texts(texts: DataFrame, total: int) -> list[list[bytes]]:
    """Training documents by a hash of their ids, up to the sample's bounds; of a document longer than
    ``SAMPLE_CHARS`` a passage whose place a hash gives. The network starts from them; ``learn_all`` goes
    over all documents after that."""
    start = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1)
    passage = F.substring("text", (start + 1).cast("int"), F.lit(SAMPLE_CHARS))
    learn = texts.filter(~F.col("held_out")).withColumn("text", passage)
    spread = F.xxhash64("doc_id", F.lit(5))
    share = int(min(1.0, 2.0 * SAMPLE_DOCS / max(1, total)) * 1_000_000) + 1
    rows = learn.filter(F.pmod(spread, F.lit(1_000_000)) < share).orderBy(spread, "text").limit(SAMPLE_DOCS).select("text").collect()
    taken, tokens = [], 0
    for (text,) in rows:
        words = words_of(text)
        if tokens + len(words) > SAMPLE_TOKENS:
            break
        tokens += len(words) + 1
        taken.append(words)
    return taken


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram, log10) and score (the model's log10 probability of the whole text).

    The network gives each token's class and, for the most frequent words of all training documents,
    the word inside it; it starts from a bounded sample and learns from all training documents, whole, in
    the tasks that hold them (so its weights depend on how rows lie in partitions). All other words are one class; inside it a word has its add-one share of
    that class's training tokens. Counts are exact and over all training documents: those of head
    words are added up in tasks, those of others where their hashes meet, so no vocabulary is held
    whole anywhere. Held-out documents (crc32 of the id modulo 7 is 2) are not learnt from.

    A null or empty text is one end token. A null id is a training row. Repeated rows are counted
    each and have equal scores. An empty table gives no rows; without training rows all counts are
    zero. Other columns are not read; long texts are scored whole."""
    key = F.col(f"`{id_col}`").cast("long")
    texts = docs.select(
        key.alias("doc_id"),
        F.coalesce(crc_mod(key, MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    size = texts.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("held_out")).alias("learn"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")
    ).first()
    frequent = head_words(texts, HEAD)
    vocabulary, network = fit(sample_texts(texts, size["rows"]), counts=frequent)
    network = learn_all(texts, vocabulary, network)
    counts = np.zeros(len(vocabulary.number) + 1, np.int64)
    for word, number in vocabulary.number.items():
        counts[number] = frequent[word]
    counts[END] = size["learn"]
    model = (vocabulary, network)  # some hundred kilobytes, sent with the function
    heads = saved(head_scores(texts, model, counts), "head-scores")
    # Buckets of words and of rows grow with the input, so that a task's share does not.
    buckets, row_buckets = max(BUCKETS, size["bytes"] // WORD_BYTES), max(BUCKETS, size["rows"] // ROWS)
    sums = saved(tail_sums(tail_entries(texts, vocabulary.number, buckets), row_buckets), "tail-sums")
    whole = sums.filter(F.col("rows").isNull()).select(F.get("total", F.lit(0)).alias("total"), F.get("known", F.lit(0)).alias("known"))
    tail_n, tail_v = whole.agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    n, v = int(counts.sum() + tail_n), int((counts > 0).sum() + tail_v)
    tails = row_sums(sums).select(F.col("key").alias("__key"), F.col("total").alias("tail_log"), F.col("known").alias("tail_known"))
    copies = heads.groupBy(F.col("key").alias("__same")).agg(F.count("*").alias("copies"))
    joined = heads.join(tails, F.col("key") == F.col("__key"), "left").join(copies, F.col("key") == F.col("__same"))
    tail_log = F.coalesce(F.col("tail_log"), F.lit(0.0)) / F.col("copies")
    tail_known = (F.coalesce(F.col("tail_known"), F.lit(0)) / F.col("copies")).cast("long")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + tail_known).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (F.col("model_log") + tail_log - F.col("n_tail") * F.lit(float(np.log10(tail_n + tail_v + 1)))).alias("score"),
    )
