"""The pipeline against the same steps in plain Python, and its stages on odd rows."""

import numpy as np
from llm_cases import empty, messy
from pyspark.sql import functions as F
from test_llm_duplicates import brute_lines, fingerprint, roots

import corpus_pipeline
from tallyworks.llm import packing, quality
from tallyworks.llm.decontamination import without_contaminated


def test_the_stages_in_plain_python(spark, data_dir, tmp_path):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    model = quality.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    score = model.score(np.array([quality.features(t or "") for _, t in rows]))
    rows = [r for r, s in zip(rows, score) if s >= quality.ACCEPT]
    cleaned = brute_lines(rows)
    rows = [(i, cleaned.get((i, t), t)) for i, t in rows]
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    ids = [i for i, _ in rows]
    pairs = [(ids[a], ids[int(b)]) for a in range(len(ids)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2) if b < a]
    root = roots(pairs, ids)
    rows = [(i, t) for i, t in rows if root[i] == i]

    def shingles(text):
        words = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in text.lower()).split()
        n = min(5, max(1, len(words)))
        return n, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}, words

    bad = set()
    for item in items:
        n, asked, _ = shingles(item)
        for i, t in rows:
            words = shingles(t)[2]
            held = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            if len(asked & held) >= 0.8 * len(asked) - 1e-9:
                bad.add(i)
    rows = [(i, t) for i, t in rows if i not in bad]
    got = corpus_pipeline.run(spark, data_dir).collect()
    encoder = packing.Encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(encoder.ids(t)) + 1 for i, t in rows}
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert bad and len(want) < docs.count()


CLASHING = ["key", "class", "n_links", "n_lines", "n_removed", "__key", "__id", "__no_id", "__own_id", "__own_key", "__row", "id", "text_key", "no_id", "column_1"]


def odd(spark, make):
    """Odd rows with columns of names that operators use themselves, each with a value of its own."""
    docs = make(spark).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING])


def test_stages_on_odd_rows(spark, data_dir):
    from llm_cases import TEXTS

    docs = odd(spark, messy)
    values = {r.doc_id: tuple(r)[5:] for r in docs.collect()}
    out = {name: stage(spark, docs, data_dir) for name, stage in corpus_pipeline.STAGES}
    for name in ("quality", "line_dedup", "near_dedup", "decontamination"):
        assert out[name].columns == docs.columns and out[name].dtypes == docs.dtypes
        rows = out[name].collect()
        assert all(tuple(r)[5:] == values[r.doc_id] for r in rows), name
    # Lines: every row stays, a null text too; the null id, the last in order, loses its line.
    lines = [(r.doc_id, r.text, r.n_chars) for r in out["line_dedup"].collect()]
    assert len(lines) == len(TEXTS) and (2, None, 0) in lines and (None, "", 0) in lines
    # Near-duplicates: texts without words are one group, so are the rows that differ in case or line ends only.
    assert sorted(str(r.doc_id) for r in out["near_dedup"].collect()) == ["1", "2", "6", "7", "8"]
    # No item is in these texts.
    assert out["decontamination"].count() == len(TEXTS)
    assert {r.doc_id for r in out["packing"].collect()} == {i for i, _ in TEXTS}
    none = odd(spark, empty)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, data_dir).count() == 0


def test_near_dedup_is_within_two_bits(spark, data_dir):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(40):
        words = [f"w{k}" for k in rng.integers(0, 5_000, rng.integers(6, 400))]
        rows.append(" ".join(words))
        for n in (0, 1, 1, 3):
            copy = list(words)
            for at in rng.choice(len(copy), n, replace=False):
                copy[at] = f"new{rng.integers(10**6)}"
            rows.append(" ".join(copy))
    rows = sorted((int(i), t) for i, t in zip(rng.permutation(len(rows)), rows))
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    pairs = [(a, int(b)) for a in range(len(rows)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2) if b < a]
    root = roots(pairs, range(len(rows)))
    want = {rows[k][0] for k in range(len(rows)) if root[k] == k}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, messy(spark, rows), data_dir).collect()} == want
    assert len(want) < len(rows) - 50


def test_rows_are_known_by_id_and_text(spark):
    one, two, three = (" ".join(f"{w}{k}" for k in range(20)) for w in "abc")
    rows = [(1, one), (1, two), (1, one), (None, two), (None, three), (None, three), (2, one.upper()), (3, None), (4, " ")]
    docs = messy(spark, rows)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(((r.doc_id or 0, r.text) for r in got.collect()), key=str) == sorted([(1, one), (1, two), (0, three), (3, None)], key=str)


def test_passages_under_null_and_repeated_ids_go(spark):
    passage = " ".join(f"item{k}" for k in range(12))
    rows = [(1, f"x {passage} y"), (1, "plain text"), (None, f"z {passage}"), (None, "other text"), (None, None), (2, "more")]
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    docs = messy(spark, rows)
    got = without_contaminated(docs, items)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([rows[1], *rows[3:]], key=str)
    assert got.columns == docs.columns and without_contaminated(empty(spark), items).count() == 0
