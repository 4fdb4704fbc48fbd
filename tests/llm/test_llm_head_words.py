"""The language model's head words come from all training documents, not from its sample."""

from collections import Counter

from llm_cases import empty, messy
from pyspark.sql import functions as F

from tallyworks.llm import language_model


def test_head_words_and_long_documents(spark, monkeypatch):
    rows = [(i, f"here w{i} " + "often " * (i % 9) + f"only{i} " * 4) for i in range(200)]
    rows += [(1_000 + i, "long " * 50_000) for i in range(4)]
    texts = messy(spark, rows).select("doc_id", (F.col("doc_id") % 7 == 2).alias("held_out"), "text")
    counts = Counter(w for i, t in rows if i % 7 != 2 for w in t.encode().split())
    want = dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:40])
    assert dict(language_model.head_words(texts, 40)) == want
    assert not language_model.head_words(texts.limit(0), 40)
    long = texts.filter("doc_id >= 1000")
    taken = language_model.sample_texts(long, long.count())
    assert taken and all(9_990 <= len(t) <= 10_001 for t in taken)
    seen = []
    fit = language_model.fit
    monkeypatch.setattr(language_model, "fit", lambda *a, **k: seen.append(fit(*a, **k)) or seen[-1])
    monkeypatch.setattr(language_model, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(language_model, "HEAD", 40)
    monkeypatch.setattr(language_model, "EPOCHS", 1)
    language_model.language_scores(messy(spark, rows[:200]))
    held = {r.doc_id for r in spark.range(200).filter(F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2).toDF("doc_id").collect()}
    counts = Counter(w for i, t in rows[:200] if i not in held for w in t.encode().split())
    assert set(seen[0][0].number) >= {w for w, _ in counts.most_common(2)}
    assert sum(w.startswith(b"only") for w in seen[0][0].number) > 12  # of more than three documents


def test_tail_sums_do_not_depend_on_the_buckets(spark, monkeypatch):
    """Packed rows are as many as there are pairs of buckets, and add up to the same sums."""
    texts = spark.createDataFrame(
        [(i, i % 7 == 2, " ".join(f"w{i * k % 97}" for k in range(i % 40))) for i in range(300)], "doc_id long, held_out boolean, text string"
    ).repartition(5)
    number = {b"w0": 1, b"w1": 2}
    want = None
    for buckets, row_buckets, added in ((1, 1, 1 << 20), (8, 8, 1 << 20), (13, 3, 10)):
        monkeypatch.setattr(language_model, "ADDED", added)
        sums = language_model.tail_sums(language_model.tail_entries(texts, number, buckets), row_buckets).cache()
        assert sums.count() <= buckets * (row_buckets + 1)
        got = {r.key: (round(r.total, 6), r.known) for r in language_model.row_sums(sums).collect()}
        assert len(got) > 200 and got == (want or got)
        want = got
