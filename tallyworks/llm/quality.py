"""Quality classifier learned from trusted positives and unlabelled text (non-negative risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import crc_mod

#: Rows that the model is fitted on: a bounded sample of the learning rows, by a hash of the id.
SAMPLE_ROWS = 24_000
HIDDEN = 16
EPOCHS = 60
BATCH = 512
RATE = 0.01
#: How far the risk of the negatives may fall below zero before it is pushed back up.
SLACK = 0.0
ACCEPT = 0.7
MODULUS, HELD_OUT = 4, 2

SYMBOLS = "!#$%&*|@<>{}[]=_^~\\/+-;:?\"'()"


def features(text: str) -> list[float]:
    """Numbers that describe how a text is written; none depends on its language or source.
    An empty text gives zeros."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * (18 + len(SYMBOLS))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    words = data.lower().split()
    n = max(1, len(words))
    seen = set(words)
    tally: dict[bytes, int] = {}
    for word in words if len(seen) < n else ():
        tally[word] = tally.get(word, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = set(zip(words, words[1:]))
    again = sum(a == b for a, b in zip(words, words[1:]))
    letters = counts[65:91].sum() + counts[97:123].sum()
    ends = counts[ord(".")] + counts[ord("!")] + counts[ord("?")]
    return [
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        counts[65:91].sum() / max(1, letters),
        letters / size,
        counts[48:58].sum() / size,
        counts[128:].sum() / size,
        counts[10] / size,
        counts[ord(".")] / n,
        counts[ord(",")] / n,
        ends / n,
        (size - counts[32]) / n / 10,
        len(seen) / n,
        max(tally.values(), default=1) / n,
        (len(pairs) + 1) / n,
        again / n,
        len(set(lines)) / max(1, len(lines)),
        min(4.0, n / max(1, len(lines)) / 25),
        *(counts[ord(s)] / n for s in SYMBOLS),
    ]


@dataclass(frozen=True)
class Model:
    """Standardised features, one hidden layer, and a line that turns margins into log-odds."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    slope: float
    shift: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def fit(x: np.ndarray, label: np.ndarray, seed: int = 7) -> Model:
    """``label``: 1, 0 or -1 (unknown). Positives are the rows labelled 1; all rows together are
    the unlabelled sample. The class prior is the share of 1 among the labelled.

    Minimises ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss; where the
    second part of a batch is negative, its gradient is turned round. The labelled rows of both
    kinds then fit the line from margins to probabilities."""
    rng = np.random.default_rng(seed)
    mean, spread = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = np.clip((x - mean) / spread, -8, 8)
    positive = z[label == 1]
    labelled = label >= 0
    prior = float(np.clip((label[labelled] == 1).mean() if labelled.any() else 0.5, 0.05, 0.95))
    params = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.25, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS if len(positive) else 0):
        order = rng.permutation(len(z))
        for low in range(0, len(z), BATCH):
            u = z[order[low : low + BATCH]]
            p = positive[rng.integers(0, len(positive), min(BATCH, len(positive)))]
            both = np.concatenate([p, u])
            h = np.tanh(both @ params[0] + params[1])
            g = h @ params[2] + params[3]
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            gp, gu = g[: len(p)], g[len(p) :]
            sp, su = s[: len(p)], s[len(p) :]
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if negative >= -SLACK:
                d = np.concatenate([(prior * (sp - 1) - prior * sp) / len(p), su / len(u)])
            else:
                d = np.concatenate([prior * sp / len(p), -su / len(u)])
            back = np.outer(d, params[2]) * (1 - h * h)
            grads = [both.T @ back + 1e-4 * params[0], back.sum(0), h.T @ d + 1e-4 * params[2], np.array([d.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, spread, params[0], params[1], params[2], float(params[3][0]), 1.0, 0.0, prior)
    slope, shift = _line(model.margin(x[labelled]), label[labelled])
    return Model(mean, spread, *params[:3], float(params[3][0]), slope, shift, prior)


def _line(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin, by Newton steps with a small penalty."""
    if len(margin) == 0 or label.min() == label.max():
        return 1.0, 0.0
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (s - label) + 1e-2 * (w - [1, 0])
        hess = (x * (s * (1 - s))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w = w - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def learning_rows(doc_id: Column) -> Column:
    return crc_mod(doc_id, MODULUS) != HELD_OUT


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
) -> Model:
    """Fit on a sample of at most ``rows`` documents outside the held-out fold. Only ids are looked
    at to sample and only the sample's features come to the driver. Rows with a null id or a null
    label, and ids labelled both ways, count as unlabelled."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    learn = keyed.filter(F.col("doc_id").isNotNull() & learning_rows(F.col("doc_id")))
    spread = F.xxhash64("doc_id", F.lit(3))
    total = max(1, learn.select("doc_id").count())
    share = min(1.0, 1.1 * rows / total)
    sample = learn.filter(F.pmod(spread, F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    truth = (
        labels.select(F.col(f"`{label_id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__label"))
        .filter(F.col("__label").isin(0, 1))
        .groupBy("__id")
        .agg(F.min("__label").alias("low"), F.max("__label").alias("high"))
        .filter("low = high")
    )
    describe = F.pandas_udf(lambda texts: texts.map(features), "array<double>")
    described = sample.select("doc_id", describe("text").alias("x"))
    taken = (
        described.join(truth, F.col("doc_id") == F.col("__id"), "left")
        .select("doc_id", "x", F.coalesce("low", F.lit(-1)).alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id")
        .limit(rows)
        .toPandas()
        .sort_values(["doc_id"], kind="stable")
    )
    width = len(features(""))
    x = np.array(taken["x"].tolist(), np.float64).reshape(-1, width)
    return fit(x, taken["label"].to_numpy(int))


def quality_score(text: Column, model: Model) -> Column:
    """The model's probability that a text is of good quality; null counts as empty."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            rows = np.array([features(t or "") for t in texts], np.float64).reshape(len(texts), -1)
            yield pd.Series(model.score(rows) if len(texts) else [], dtype="float64")

    return score(text)


def score_quality(
    docs: DataFrame, labels: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", **names
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1) and predicted (1 from 0.7 on).

    Texts are scored whole in one scan without a shuffle. Null and empty texts have the score of an
    empty text; repeated rows have equal scores; a null id is not held out; an empty table gives no
    rows. Without positives the score is that of an untrained model. Other columns are not read."""
    model = model or train(docs, labels, id_col=id_col, text_col=text_col, **names)
    scored = docs.select(F.col(f"`{id_col}`").alias("doc_id"), quality_score(F.col(f"`{text_col}`"), model).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(~learning_rows(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that the model accepts, with their columns."""
    return docs.filter(quality_score(F.col(f"`{text_col}`"), model) >= ACCEPT)
