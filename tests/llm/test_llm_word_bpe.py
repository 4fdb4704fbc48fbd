"""BPE encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import TEXTS, empty, messy
from tokenizers import Tokenizer

from tallyworks.llm import word_bpe
from tallyworks.llm.queries import op11_word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "Don't STOP's <|endoftext|>x<|startoftext|><|endoftext|", "<|endoftext|>", "ΟΔΥΣΣΕΥΣ Σ ςσ", "İstanbul", "漢字かな123",
    "aaa aaaa aaaaa " + "a" * 5000, "x" * 100_000, "é é Ǆ ﬁ", "\x1c\x1d a\x85b\x00c ​ ", "🤦🏽‍♂️ 🚀!!", "'s's'll'", "ẞß 𐐀𐐁 Ω K",
]


def digest(parts):
    return hashlib.sha256(" ".join(parts).encode()).hexdigest()


def wanted(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), digest(map(str, ids)), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.fixture(scope="module")
def parts():
    with open(PATH, encoding="utf-8") as f:
        return word_bpe.vocabulary(f.read())


def test_odd_texts(spark):
    rows = [*TEXTS, *((100 + i, t) for i, t in enumerate(ODD))]
    got = word_bpe.encoded(messy(spark, rows), PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted((str(i), *wanted(t)) for i, t in rows)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert word_bpe.encoded(empty(spark), PATH).count() == 0


def test_whole_table(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op11_word_bpe(spark, data_dir).collect()}
    assert got == {r.doc_id: wanted(r.text) for r in docs}


def test_any_characters(parts):
    rng = random.Random(5)
    limits = (0x7F, 0x250, 0x600, 0x3100, 0xD800)
    texts = ["".join(chr(rng.randrange(rng.choice(limits))) for _ in range(rng.randrange(1, 30))) for _ in range(3_000)]
    assert list(word_bpe.Encoder(parts).digests(texts)) == [wanted(t) for t in texts]


def test_pieces_and_forgetting_change_nothing(parts, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["the", "an", "x<|endoftext|>y", "über", "tion"], 400)) + "q" * int(k) for k in rng.integers(0, 90, 20)]
    whole = list(word_bpe.Encoder(parts).digests(texts))
    for name, value in (("PIECE", 50), ("KNOWN", 3), ("REMEMBER", 2), ("TOGETHER", 4)):
        monkeypatch.setattr(word_bpe, name, value)
    monkeypatch.setattr(word_bpe.pieces, "__defaults__", (50,))
    assert list(word_bpe.Encoder(parts).digests(texts)) == whole == [wanted(t) for t in texts]


def test_only_words_with_a_bad_pair_are_merged(parts):
    tables = word_bpe.Tables(parts)
    words = sorted({w for t in ODD for w in word_bpe.Words(parts["cutting"]).cut(t)} | {"erchandise", "thereof", "the", "ing", "unbelievable", "thhethea"})
    merged = [LIBRARY.encode(w, add_special_tokens=False).ids for w in words]
    flat, ends, exact = tables.encode(words)
    assert [flat[low:high] for low, high in zip([0, *ends], ends)] == merged and 0 < exact < len(words)


def test_pairs_stand_as_their_letters_merge(parts):
    """Whether a pair of tokens stands is whether merging its letters gives the pair back."""
    tables = word_bpe.Tables(parts)
    rng = np.random.default_rng(0)
    # Inner tokens first, any token after: what each is made of, as symbols.
    symbol = {int(t): s for s, t in enumerate(tables.base)}

    def letters(token):
        return [symbol[token]] if tables.made[token] < 0 else letters(int(tables.left[token])) + letters(int(tables.right[token]))

    sound = [int(t) for t in tables.accepts if t >= 0]
    inner = [t for t in sound if letters(t)[-1] < word_bpe.LAST]
    a, b = rng.choice(inner, 3_000), rng.choice(sound, 3_000)
    b[:1500] = rng.choice(sound[:800], 1500)
    want = [tables.merged_long(letters(int(x)) + letters(int(y))) == [x, y] for x, y in zip(a, b)]
    assert tables.apart(a, b).tolist() == want and 0 < sum(want) < 3_000
