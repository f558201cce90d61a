"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are its byte strings of 1 to 4, lower-cased in A-Z; each is hashed to a row of an
embedding table, the rows are averaged over the whole text, and a softmax gives a probability for each
language. Table and weights are trained together by stochastic gradient descent in numpy on the driver,
from a bounded sample of labelled texts; a fifth of the sample sets the temperature, which calibrates
the probabilities, and the level below which a prediction is rejected.

Parameters that bound the sample: ``sample`` texts over all languages, each of at most ``longest`` bytes
(training only; every text is predicted whole).

Defined cases: a null text or one without letters is ``und`` with score 0 and not accepted; so is every
text if nothing is labelled; a null ``doc_id`` belongs to the training side; repeated rows are predicted
alike; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneloom.llm.common import LOWER, slices, small_batches, text_bytes

ORDERS = 4
ROWS = 1 << 16
WIDTH = 16
PRECISION = 0.995  # that accepted predictions should have


def subwords(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the table row of the subword that starts at each byte, ROWS where a text ends before."""
    low = LOWER[data].astype(np.uint32)
    gram = np.zeros(len(data), np.uint32)
    for k in range(ORDERS):
        n = len(data) - k
        if n <= 0:
            return
        gram = gram[:n] * np.uint32(0x01000193) + low[k:] + np.uint32(1)
        rows = ((gram * np.uint32(0x9E3779B1)) ^ np.uint32(0x5BD1E995 * (k + 1) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B) >> np.uint32(16)
        rows = rows.astype(np.int32)
        for j in range(1, k + 1):
            ends = at[1:] - j
            rows[ends[(ends >= 0) & (ends < n)]] = ROWS
        yield rows


def has_letters(texts: pa.Array) -> list[bool]:
    return [bool(t) and any(map(str.isalpha, t)) for t in texts.to_pylist()]


class Model:
    """Scores of the languages for every table row, and how to calibrate them."""

    def __init__(self, names: list[str], scores: np.ndarray, bias: np.ndarray, temperature: float, least: float):
        self.names, self.scores, self.bias, self.temperature, self.least = names, scores, bias, temperature, least

    def chances(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(texts, languages) probabilities."""
        n = len(at) - 1
        sums, counts = np.zeros((n, len(self.names))), np.zeros(n)
        full = np.flatnonzero(np.diff(at) > 0)
        if len(full):
            for k, rows in enumerate(subwords(data, at)):
                starts = np.minimum(at[full], max(0, len(rows) - 1))
                live = at[full] < len(rows)
                for c in range(len(self.names)):
                    part = np.add.reduceat(self.scores[:, c][rows], starts, dtype=np.float64)
                    sums[full, c] += np.where(live, part, 0.0)
                counts += np.maximum(0, np.diff(at) - k)
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and weights of each text's average."""
    out = []
    for t in texts:
        data, at = text_bytes(pa.array([t], pa.large_string()))
        parts = list(subwords(data, at))
        rows, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)
        counts = counts[rows < ROWS].astype(np.float32)
        rows = rows[rows < ROWS]
        out.append((rows, counts / max(1.0, counts.sum())))
    return out


def train(texts: list[str], langs: list[str], epochs: int = 4, rate: float = 0.3, seed: int = 5) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    label = np.array([names.index(x) for x in langs])
    bags = _bags(texts)
    order = rng.permutation(len(bags))
    held, own = order[: len(order) // 5], order[len(order) // 5 :]
    table = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((WIDTH, len(names)), np.float32), np.zeros(len(names), np.float32)
    steps, done = epochs * max(1, len(own)), 0
    for _ in range(epochs):
        for i in rng.permutation(own):
            rows, share = bags[i]
            if not len(rows):
                continue
            now = rate * (1 - done / steps)
            done += 1
            mean = share @ table[rows]
            z = mean @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = weight @ p
            weight -= now * np.outer(mean, p)
            bias -= now * 0.1 * p
            # the step that moves the average by the rate, dealt to the rows by their weight
            table[rows] -= (now / float(share @ share)) * share[:, None] * back[None, :]
    scores = np.vstack([table @ weight, np.zeros((1, len(names)), np.float32)]).astype(np.float32)
    model = Model(names, scores, bias.astype(np.float64), 1.0, 0.0)
    check = held if len(held) else own
    z = np.array([bags[i][1] @ scores[bags[i][0]] for i in check]).reshape(len(check), len(names)) + bias
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 60):
        e = z / t
        e = e - e.max(axis=1, keepdims=True)
        loss = -(e[np.arange(len(check)), label[check]] - np.log(np.exp(e).sum(axis=1))).mean() if len(check) else 0.0
        best = min(best, (float(loss), float(t)))
    model.temperature = best[1]
    if len(check):
        e = np.exp((z - z.max(axis=1, keepdims=True)) / best[1])
        p = e / e.sum(axis=1, keepdims=True)
        top, right = p.max(axis=1), p.argmax(axis=1) == label[check]
        down = np.argsort(-top)
        good = np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= PRECISION
        model.least = float(top[down][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = 6_000, longest: int = 1 << 16) -> Model | None:
    """A model from a sample of the labelled texts that are not held out, the same share of each language."""
    able = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
                       & (F.octet_length("text") <= longest) & (F.octet_length("text") > 0))
    rows = able.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").withColumn("h", F.xxhash64("doc_id", "lang"))
    each = max(1, sample // max(1, rows.select("lang").distinct().count()))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = rows.withColumn("place", place).filter(F.col("place") <= each).select(F.col("doc_id").alias("_id")).distinct()
    texts = able.join(F.broadcast(chosen), F.col("doc_id").cast("long").eqNullSafe(F.col("_id")))  # at most ``sample`` ids
    found = texts.groupBy("_id", "lang").agg(F.min("text").alias("text")).toPandas().sort_values(["_id", "lang"])
    return train(found["text"].tolist(), found["lang"].tolist())


def _predictor(model: Model | None) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, accepted = [], [], []
            for lo, hi, data, at in slices(b.column("text")):
                letters = has_letters(b.column("text").slice(lo, hi - lo))
                if model is None:
                    letters, p = [False] * (hi - lo), np.zeros((hi - lo, 1))
                else:
                    p = model.chances(data, at)
                top = p.argmax(axis=1)
                for ok, t, s in zip(letters, top.tolist(), p.max(axis=1).tolist(), strict=True):
                    lang.append(model.names[t] if ok else "und")
                    score.append(s if ok else 0.0)
                    accepted.append(ok and s >= model.least)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(accepted, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The language of every text, trained from the documents themselves unless a model is given."""
    small_batches(docs.sparkSession)
    model = model or fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_predictor(model), "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
