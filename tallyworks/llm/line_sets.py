"""Token sets of the lines of many texts at once, straight from an Arrow column's bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa

#: Bytes whose lines are handed on together, and that are hashed at a time, which is faster where the
#: arrays fit the CPU's cache; a longer line is taken whole.
PIECE, STEP = 1 << 21, 1 << 17
_RANDOM = np.random.default_rng(20240)
#: A word's hash is the sum of its bytes' values times powers of an odd number, modulo 2^64.
VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
VALUES[65:91] = VALUES[97:123]  # A-Z count as a-z
ODD = 0x9E3779B97F4A7C15 | 3


@dataclass
class Lines:
    """Of each line with a token: the row of its text, its number there, and its distinct tokens as
    hashes in rising order, one line after the other."""

    row: np.ndarray
    number: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def classes(self) -> np.ndarray:
        """A hash of each token set."""
        if not len(self.sizes):
            return np.zeros(0, np.int64)
        return mixed(np.add.reduceat(self.tokens, self.starts)).view(np.int64)

    def only(self, keep: np.ndarray) -> Lines:
        return Lines(self.row[keep], self.number[keep], self.sizes[keep], self.tokens[np.repeat(keep, self.sizes)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(ODD, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(pow(ODD, -1, 1 << 64), k, 1 << 64))])
        return self.up[:n], self.down[:n]


def line_sets(column: pa.StringArray, powers: Powers) -> Iterator[Lines]:
    """Pieces of whole lines. Words are cut at ASCII white space, lines at line feeds."""
    if not len(column):
        return
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    base = offsets[0]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[base : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    offsets = offsets - base
    feeds = np.flatnonzero(data == 10)
    per_row = 1 + np.diff(np.searchsorted(feeds, offsets))
    row = np.repeat(np.arange(len(column)), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([feeds, offsets[1:]]))
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + PIECE, "right")))
        found = []
        while low < high:
            to = min(high, max(low + 1, int(np.searchsorted(ends, starts[low] + STEP, "right"))))
            found.append(_piece(data[starts[low] : ends[to - 1]], starts[low:to] - starts[low], row[low:to], number[low:to], powers))
            low = to
        yield Lines(*(np.concatenate([getattr(x, f.name) for x in found]) for f in fields(Lines)))


def _piece(data, starts, row, number, powers) -> Lines:
    word = (data != 32) & (data - np.uint8(9) > 4)
    fresh = np.zeros(len(data) + 1, bool)
    fresh[starts] = True  # texts follow each other without a separator
    before, after = np.append(False, word[:-1]), np.append(word[1:], False)
    first = np.flatnonzero(word & (~before | fresh[:-1]))
    last = np.flatnonzero(word & (~after | fresh[1:])) + 1
    up, down = powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * up[:-1], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * down[first])
    line = np.repeat(np.arange(len(starts)), np.diff(np.searchsorted(first, starts), append=len(first)))
    bits = max(1, int(len(starts)).bit_length())
    order = np.argsort((line.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits)))
    line, hashes = line[order], hashes[order]
    line, hashes = _settle(line, hashes)
    if len(line):
        new = np.append(True, (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1]))
        line, hashes = line[new], hashes[new]
    sizes = np.bincount(line, minlength=len(starts))
    has = sizes > 0
    return Lines(row[has], number[has], sizes[has], hashes)


def _settle(line, hashes):
    """Neighbours that the packed key left in the wrong order are put right."""
    while True:
        wrong = np.flatnonzero((line[1:] == line[:-1]) & (hashes[1:] < hashes[:-1]))
        if not len(wrong):
            return line, hashes
        wrong = wrong[np.append(True, np.diff(wrong) > 1)]
        hashes[wrong], hashes[wrong + 1] = hashes[wrong + 1].copy(), hashes[wrong].copy()


def by_rarity(lines: Lines, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each line from rare to frequent (equal counts by hash), and their counts."""
    line = np.repeat(np.arange(len(lines.sizes)), lines.sizes)
    bits = max(1, int(len(lines.sizes)).bit_length())
    rank = np.minimum(count, (1 << 24) - 1).astype(np.uint64)
    key = (line.astype(np.uint64) << np.uint64(64 - bits)) | (rank << np.uint64(40 - bits)) | (lines.tokens >> np.uint64(24 + bits))
    order = np.argsort(key)
    key, tokens, count, rank = key[order], lines.tokens[order], count[order], rank[order]
    while True:
        wrong = np.flatnonzero((key[1:] == key[:-1]) & (tokens[1:] < tokens[:-1]))
        if not len(wrong):
            return tokens, count
        wrong = wrong[np.append(True, np.diff(wrong) > 1)]
        for values in (tokens, count):
            values[wrong], values[wrong + 1] = values[wrong + 1].copy(), values[wrong].copy()
