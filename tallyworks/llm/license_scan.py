"""License scan: exact phrases, and short notices found with errors by exact seeds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyworks.llm.common import LOWER, texts_of

# The phrases that always count, by label.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices as words with single spaces, by label, with the words that name the license.
NOTICES = (
    ("released under the mit license", "mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ""),
    ("released under the isc license", "isc", "isc"),
    ("released under the bsd license", "bsd", "bsd"),
    ("redistribution and use in source and binary forms with or without modification", "bsd", ""),
    ("licensed under the apache license version 2 0", "apache", "apache"),
    ("licensed under the gnu general public license version", "gpl", "gnu general public"),
    ("licensed under the gnu lesser general public license version", "lgpl", "gnu lesser general public"),
    ("licensed under the gnu affero general public license version", "agpl", "gnu affero general public"),
    ("this program is free software you can redistribute it and or modify it", "gpl", ""),
    ("released under the mpl license", "mpl", "mpl"),
    ("subject to the terms of the mozilla public license", "mpl", "mozilla public"),
    ("licensed under cc by 4 0", "cc-by", "cc by"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "cc by nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "cc by nc nd"),
    ("licensed under a creative commons attribution", "cc-by", "creative commons attribution"),
    ("licensed under a creative commons attribution sharealike", "cc-by-sa", "attribution sharealike"),
    ("licensed under a creative commons attribution noderivatives", "cc-by-nd", "attribution noderivatives"),
    ("licensed under a creative commons attribution noncommercial", "cc-by-nc", "attribution noncommercial"),
    ("licensed under a creative commons attribution noncommercial sharealike", "cc-by-nc-sa", "noncommercial sharealike"),
    ("licensed under a creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", "noncommercial noderivatives"),
)
# Words that, right behind the naming words, name another license.
GOES_ON = frozenset("nc sa nd noncommercial non sharealike share noderivatives noderivs no".split())
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label: string, start_word: long, end_word: long, edits: int>>"
)
# Bytes that separate words become spaces; A-Z become a-z.
TO_WORDS = bytes(
    LOWER[b] if 48 <= LOWER[b] <= 57 or 97 <= LOWER[b] <= 122 or b >= 128 else 32 for b in range(256)
)


def edits_allowed(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def seeds(notice: str) -> list[tuple[int, str]]:
    """Offset and text of ``edits + 1`` pieces: a place with at most that many edits has one of
    them unchanged, so the search for pieces loses none."""
    n = edits_allowed(notice) + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(cuts[i], notice[cuts[i] : cuts[i + 1]]) for i in range(n)]


class NoticeSearch:
    """Finds notices in a normalised text. Built once in a task."""

    def __init__(self, notices=NOTICES, phrases: Mapping[str, str] = PHRASES):
        self.notices = [(text, label, edits_allowed(text)) for text, label, _ in notices]
        self.naming = [tuple(names.split()) for _, _, names in notices]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (text, _, _) in enumerate(self.notices):
            for offset, piece in seeds(text):
                places.setdefault(piece, []).append((number, offset))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={k}}}") for text, _, k in self.notices
        ]
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases.items()]

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int]]:
        """Label, start, end and edits of each place, by start; of overlapping places of one notice
        the first with the fewest edits."""
        best: dict[int, list[tuple[int, int, int]]] = {}
        for end, (length, where) in self.pieces.iter(text):
            for number, offset in where:
                notice, _, k = self.notices[number]
                start = max(0, end + 1 - length - offset - k)
                stop = min(len(text), end + 1 - length - offset + len(notice) + k)
                found = best.setdefault(number, [])
                if found and found[-1][0] <= end + 1 - length and end < found[-1][1] and not found[-1][2]:
                    continue
                m = self.patterns[number].search(text, start, stop)
                if m is None or m.end() == m.start() or not self.names(number, text, m.start(), m.end()):
                    continue
                place = (m.start(), m.end(), sum(m.fuzzy_counts))
                if found and place[0] < found[-1][1]:
                    if place[2] < found[-1][2]:
                        found[-1] = place
                else:
                    found.append(place)
        found = [(place[2], -len(self.notices[n][0]), n, place) for n, places in best.items() for place in places]
        # Of notices of different licenses in one place the nearest counts, of equally near ones the longest.
        kept: list[tuple[str, int, int, int]] = []
        for _, _, n, (start, end, edits) in sorted(found):
            label = self.notices[n][1]
            if all(label == other or start >= high or end <= low for other, low, high, _ in kept):
                kept.append((label, start, end, edits))
        return sorted(kept)

    def names(self, number: int, text: str, start: int, end: int) -> bool:
        """Whether the place, taken to whole words and one further, has the naming words unchanged, and
        none behind them that makes them the name of another license."""
        wanted = self.naming[number]
        if not wanted:
            return True
        low, high = text.rfind(" ", 0, start) + 1, text.find(" ", end)
        words = text[low : high if high >= 0 else len(text)].split()
        behind = text[high + 1 : high + 20].split() if high >= 0 else []
        words += behind[:1]
        n = len(wanted)
        return any(
            tuple(words[i : i + n]) == wanted and (i + n == len(words) or words[i + n] not in GOES_ON)
            for i in range(len(words) - n + 1)
        )

    def exact(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Start word and label of every place where a phrase's words follow each other."""
        places = []
        for phrase, label in self.phrases:
            last, at = phrase[-1], len(phrase) - 2
            while True:
                try:
                    at = words.index(last, at + 1)
                except ValueError:
                    break
                start = at - len(phrase) + 1
                if tuple(words[start : at + 1]) == phrase:
                    places.append((start, label))
        return sorted(places)

    def row(self, doc_id: int, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()
        joined = b" ".join(words)
        base = self.exact(words) if any(p[-1] in joined for p, _ in self.phrases) else []
        plain = joined.decode("utf-8", "surrogatepass")
        spans, score = [], 1.0 if base else 0.0
        for label, start, end, edits in self.fuzzy(plain):
            first = plain.count(" ", 0, start)
            spans.append({"label": label, "start_word": first, "end_word": first + plain.count(" ", start, end) + 1, "edits": edits})
            score = max(score, 1.0 - edits / (2.0 * CHARS_PER_EDIT))
        labels = {label for _, label in base}
        return (
            doc_id, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted(labels)), ",".join(sorted(labels | {s["label"] for s in spans})), score, spans,
        )


def license_scan(
    docs: DataFrame, notices=NOTICES, phrases: Mapping[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document, read once without a shuffle.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. ``n_base``
    counts the places of ``phrases``; ``first_word`` and ``last_word`` are their first and last
    start (null: none). ``spans`` are the places of ``notices`` with at most one edit for each
    twelve characters, in words; the words that name the license must be unchanged, and of notices of
    different licenses in one place the nearest counts, of equally near ones the longest. ``labels`` are
    those of both; ``score`` is 1 for a phrase or an unchanged notice, less for edits, 0 for neither.

    Null ids stay. Null and empty texts: no words, no labels, score 0. Repeated rows give repeated rows; an empty
    table gives no rows; other columns are not read; long texts are searched whole."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(notices, phrases)
        for batch in batches:
            rows = [search.row(i, t) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), ARROW)], names=NAMES
                )

    return texts_of(docs, id_col, text_col).mapInArrow(scan, SCHEMA)


NAMES = "doc_id n_words n_base first_word last_word base_labels labels score spans".split()
ARROW = [
    *[pa.int64()] * 5, pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32())])),
]
