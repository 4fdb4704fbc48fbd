"""Rows with nulls, empty and very long texts, ties, repeats and columns whose names clash."""

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
EXTRA = "hash key class score component_id n_links rule spans item_id bucket held_out fp rep"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in EXTRA.split())
TEXTS = [
    (1, "One two three four five six seven."),
    (1, "One two three four five six seven."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one TWO three\nfour five six seven."),
    (None, "one two three four five six seven."),
    (6, LONG),
    (7, "é è 漢字 one\ntwo"),
    (8, "x"),
]


def messy(spark, texts=TEXTS):
    data = [(i, t, "en", "s", len(t or ""), *([None] * len(EXTRA.split()))) for i, t in texts]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect() if r[key] is not None}
