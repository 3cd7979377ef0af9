"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are hashed n-grams (1 to 3) of the lower-cased letters, other characters being word borders; a document's vector
is counts times inverse document frequency at length one. Document frequencies are counted over all training documents.
The weights are fitted on a bounded sample of them by follow-the-regularised-leader with L1 and L2 penalties, and a
temperature is fitted on a part of the sample that the weights have not seen.

Nulls and edge cases: a null text or one without letters is `und` with score 0. Rows without a label are not learned from.
With no labelled row every document is `und`. Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomframe.llm.codepoints import SPACE, codes, letters_table, pieces
from loomframe.llm.common import batches_of, col, released, written
from loomframe.plans.runtime import settle

BITS = 14
FEATURES = 1 << BITS
ORDERS = (1, 2, 3)
# Documents per language that the weights and the temperature are fitted on.
SAMPLE = 1500
UNKNOWN = "und"
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _mapped(text: str, table: np.ndarray):
    for p in pieces(text):
        yield table[codes(p)]
    yield np.array([SPACE], np.uint32)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text, in pieces of bounded size; None if it has no letter."""
    counts, carry, some = np.zeros(FEATURES, np.int64), np.array([SPACE], np.uint32), False
    table = letters_table()
    for points in _mapped(text or "", table):
        blank = points == SPACE
        before = np.concatenate([[carry[-1] == SPACE], blank[:-1]])
        points = points[~(blank & before)]
        some = some or bool((points != SPACE).any())
        joined = np.concatenate([carry, points]).astype(np.uint64)
        for n in ORDERS:
            # n-grams that end in the new part
            first = max(0, len(carry) - n + 1)
            window = joined[first:]
            size = len(window) - n + 1
            if size <= 0:
                continue
            h = np.full(size, n, np.uint64)
            for k in range(n):
                h = (h ^ window[k:k + size]) * MULTIPLIERS[k]
            counts += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=FEATURES)
        carry = joined[-(max(ORDERS) - 1):].astype(np.uint32)
    return counts if some else None


@dataclass
class LanguageModel:
    """Inverse document frequencies, weights (feature x language), intercepts and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = counts.astype(np.float32) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax((self.vectors(counts) @ self.weights + self.bias) / self.temperature)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        for a in range(0, len(texts), 64):
            found = [(a + i, c) for i, t in enumerate(texts[a:a + 64]) if (c := ngram_counts(t)) is not None]
            if found:
                p = self.probabilities(np.stack([c for _, c in found]))
                best = p.argmax(axis=1)
                for (i, _), row, k in zip(found, p, best):
                    names[i], scores[i] = self.languages[k], float(min(1.0, row[k]))
        return names, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int, epochs: int = 3, alpha: float = 2.0,
             beta: float = 1.0, l1: float = 2e-3, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights by the per-coordinate follow-the-regularised-leader rule; rows are (feature numbers, values)."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(i):
        step = (beta + np.sqrt(n[i])) / alpha + l2
        return np.where(np.abs(z[i]) > l1, -(z[i] - np.sign(z[i]) * l1) / step, 0.0)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            i, v = rows[r]
            i, v = np.append(i, FEATURES), np.append(v, 1.0)  # the last feature is the intercept
            w = weights(i)
            p = softmax((v @ w)[None, :])[0]
            p[labels[r]] -= 1.0
            g = v[:, None] * p[None, :]
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss on unseen rows (golden-section search on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = softmax(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    a, b, g = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


COUNTED = pa.schema([("feature", pa.int32()), ("lang", pa.string()), ("n", pa.int64())])
FEATURED = pa.schema([("lang", pa.string()), ("r", pa.int32()), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
FITTED = pa.schema([("feature", pa.int32()), ("w", pa.list_(pa.float64()))])


def feature_rows(batch: pa.RecordBatch) -> list[tuple]:
    """Rows of (lang, r, at, value), the lists as arrays: as Python numbers the sample would take ten times the memory."""
    lists = [[v.values.to_numpy() for v in batch.column(i)] for i in (2, 3)]
    return list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *lists))


def fit_languages(labelled: DataFrame, sample: int = SAMPLE, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on rows of (text, language). `sample` distinct texts per language, drawn by hash (all if there are fewer), fit
    the weights; document frequencies cover all rows."""
    rows = labelled.select(col(text_col).cast("string").alias("text"), col(lang_col).cast("string").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches):
        df, langs = np.zeros(FEATURES, np.int64), {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                counts = ngram_counts(text)
                if counts is not None:
                    df += counts > 0
                    langs[lang] = langs.get(lang, 0) + 1
        at = np.flatnonzero(df)
        yield from batches_of(COUNTED, [at, [None] * len(at), df[at]])
        yield from batches_of(COUNTED, [[-1] * len(langs), list(langs), list(langs.values())])

    counted = (rows.mapInArrow(released(frequencies), "feature int, lang string, n long").groupBy("feature", "lang").agg(F.sum("n").alias("n"))).toPandas()
    per_lang = counted[counted["feature"] < 0]
    langs = sorted(per_lang["lang"])
    total = int(per_lang["n"].sum())
    df = np.zeros(FEATURES)
    grams = counted[counted["feature"] >= 0]
    df[grams["feature"].to_numpy()] = grams["n"].to_numpy()
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    if not langs:
        return LanguageModel([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)

    # the smallest hashes of each language's distinct texts; the row limit is applied before and after the shuffle
    hashed = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    order = W.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 32)), "h")
    chosen = hashed.select("lang", "h").distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= sample)
    drawn = hashed.join(settle(chosen).hinted(), ["lang", "h"]).dropDuplicates(["lang", "h"])  # copies count once

    def features(batches):
        for batch in batches:
            out = []
            for text, lang, r in zip(*(c.to_pylist() for c in batch.columns)):
                counts = ngram_counts(text)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    x = counts[at] * idf[at]
                    out.append((lang, r, at, x / np.linalg.norm(x)))
            yield from batches_of(FEATURED, list(zip(*out)) or [[]] * 4, 1000)

    drawn = drawn.select("text", "lang", "r")
    held = written(drawn.mapInArrow(released(features), "lang string, r int, at array<int>, value array<float>"))

    def train(batches):
        rows = sorted((r for b in batches for r in feature_rows(b)), key=lambda r: r[:2])
        labels = np.array([langs.index(r[0]) for r in rows], dtype=int)
        vectors = [r[2:] for r in rows]
        aside = np.array([r[1] % 5 == 0 for r in rows], dtype=bool)
        fit = np.flatnonzero(~aside)
        w, b = fit_ftrl([vectors[i] for i in fit], labels[fit], len(langs))
        seen = np.array([v @ w[i] + b for i, v in vectors]).reshape(-1, len(langs))
        t = fit_temperature(seen[aside], labels[aside])
        at = np.flatnonzero(np.abs(w).sum(axis=1))
        yield from batches_of(FITTED, [[*at.tolist(), -1, -2], [*w[at].tolist(), b.tolist(), [t]]])

    # the sample is bounded: one task fits it
    model = held.coalesce(1).mapInArrow(released(train), "feature int, w array<double>").toPandas()
    weights, bias, temperature = np.zeros((FEATURES, len(langs)), np.float32), np.zeros(len(langs)), 1.0
    for i, w in zip(model["feature"], model["w"]):
        if i == -1:
            bias = np.asarray(w)
        elif i == -2:
            temperature = float(w[0])
        else:
            weights[i] = w
    return LanguageModel(langs, idf, weights, bias.astype(np.float32), temperature)


def language_of(model: LanguageModel, text: Column) -> Column:
    """A struct of lang_pred and score for a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(text)
