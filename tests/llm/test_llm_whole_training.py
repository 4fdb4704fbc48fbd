"""The language model's network learns from all training documents, not from its sample alone."""

import uuid

import numpy as np
from llm_cases import empty, messy
from pyspark.sql import functions as F

from tallyworks.llm import language_model


def corpus(spark, rows):
    return messy(spark, rows).select("doc_id", (F.col("doc_id") % 7 == 2).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))


def start(texts):
    frequent = language_model.head_words(texts, 50)
    return language_model.fit([[b"a", b"b"]], counts=frequent)


def test_every_training_token_is_learnt_once(spark, monkeypatch, tmp_path):
    """Counted where the gradients are added up: also long documents, and what does not fill the lanes."""
    rows = [(i, f"a b w{i % 5} " * (i % 11)) for i in range(400)] + [(1_000, "long " * 70_000), (1_001, ""), (1_002, None)]
    texts = corpus(spark, rows).coalesce(3)
    vocabulary, network = start(texts)
    monkeypatch.setattr(language_model, "PASS_TOKENS", 5_000)
    monkeypatch.setattr(language_model, "PASS_LANES", 7)
    update, to = language_model.Descent.update, str(tmp_path)

    def counted(self, grad, size, rate):
        with open(f"{to}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(size))
        update(self, grad, size, rate)

    monkeypatch.setattr(language_model.Descent, "update", counted)
    before = {k: v.copy() for k, v in network.p.items()}
    language_model.learn_all(texts, vocabulary, network)
    learnt = [r for r in texts.collect() if not r.held_out]
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == sum(len(r.text.split()) + 1 for r in learnt)
    assert all(np.isfinite(v).all() and v.shape == before[k].shape for k, v in network.p.items())
    assert not np.array_equal(before["wc"], network.p["wc"])


def test_a_pattern_outside_the_sample_is_learnt(spark, monkeypatch):
    """Two words follow each other only in documents that the sample does not take."""
    rng = np.random.default_rng(3)
    rows = [(7 * i, " ".join(rng.choice(["a", "b", "c", "d"], 60))) for i in range(300)]
    rows += [(7 * i + 1, "x y " * 30) for i in range(300)]
    texts = corpus(spark, rows).repartition(3, "doc_id")
    monkeypatch.setattr(language_model, "PASS_LANES", 8)
    sample = [t.encode().split() for _, t in rows[:100]]
    vocabulary, network = language_model.fit(sample, counts=language_model.head_words(texts, 50))
    coded = [vocabulary.ids(b"x y x y x y x y".split())]
    before = language_model.score_group(network, network.table(), coded)[0]
    network = language_model.learn_all(texts, vocabulary, network)
    after = language_model.score_group(network, network.table(), coded)[0]
    assert after > before + 2
    again = language_model.fit(sample, counts=language_model.head_words(texts, 50))[1]
    again = language_model.learn_all(texts, vocabulary, again)
    assert all(np.allclose(again.p[k], v, atol=1e-4) for k, v in network.p.items())


def test_no_training_rows(spark):
    texts = corpus(spark, [(2, "a b"), (9, "c")])
    vocabulary, network = start(texts)
    before = {k: v.copy() for k, v in network.p.items()}
    after = language_model.learn_all(texts.filter("held_out"), vocabulary, network)
    assert all(np.array_equal(before[k], after.p[k]) for k in before)
    assert language_model.language_scores(empty(spark)).count() == 0
