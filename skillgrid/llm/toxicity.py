"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct hashed character 3- to 5-grams of a text. Over a bounded sample of labelled texts
Spark counts in how many of either class each occurs; the ratio's logarithm scales a feature, and
those that tell the classes apart enter a logistic regression (Wang and Manning, 2012).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_SCHEMA, arrow_column, chunk_rows, letter_codes, ngram_hashes, sigmoid, slices, summed_chunks, unit_hash, utf8

SIZES, BITS = (3, 4, 5), 19
DIMENSIONS = 1 << BITS
CHUNKS = 32
TRAINING = 16_000  # labelled texts that are learned from, about: half of them toxic if there are so many
FEATURES = 1 << 11  # features of the regression, the most telling first
LEAST = 4  # texts in which a feature must occur
RIDGE = 5e-4
THRESHOLD = 0.3


def features_of(text: str) -> np.ndarray:
    """Hashes of the n-grams of a text, repeats included."""
    return ngram_hashes(letter_codes(text), SIZES, BITS)


@dataclass
class Model:
    slot: np.ndarray  # of each hash, -1 if it is no feature
    weights: np.ndarray
    bias: float

    def present(self, text: str) -> np.ndarray:
        slots = self.slot[features_of(text)]
        return np.unique(slots[slots >= 0])

    def score(self, text: str | None) -> float:
        return sigmoid(self.bias + (float(self.weights[self.present(text)].sum()) if text else 0.0))


def regression(offsets: np.ndarray, columns: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on 0/1 features times ``scale``, by accelerated gradients.

    Row i has the features ``columns[offsets[i]:offsets[i + 1]]``. Weights come back for unscaled features.
    """
    rows = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(offsets))
    weight = weight / weight.sum()
    value = scale[columns].astype(np.float32)
    prior = float((weight * y).sum())
    w, bias = np.zeros(len(scale)), float(np.log(prior / (1 - prior)))
    norms = np.bincount(rows, value * value, len(y))
    step = 1 / (0.25 * (float(norms.max(initial=0)) + 1) * 0.2 + RIDGE)
    v, b, t = w.copy(), bias, 1.0
    loss_before = np.inf
    for _ in range(rounds):
        z = np.bincount(rows, value * v[columns], len(y)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = float(-(weight * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum() + RIDGE / 2 * (v * v).sum())
        if loss > loss_before + 1e-9:  # overshot: shorter steps, momentum anew
            step, t = step / 2, 1.0
            v, b = w.copy(), bias
            loss_before = np.inf
            continue
        loss_before = loss
        g = weight * (p - y)
        fresh = v - step * (np.bincount(columns, value * g[rows], len(scale)) + RIDGE * v)
        fresh_bias = b - step * float(g.sum())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b = fresh + (t - 1) / t_next * (fresh - w), fresh_bias + (t - 1) / t_next * (fresh_bias - bias)
        w, bias, t = fresh, fresh_bias, t_next
    return w * scale, bias


def fit(
    docs: DataFrame, labels: DataFrame, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", training: int = TRAINING,
) -> Model:
    """A model from the labels of ids that ``allowed`` (on the labels) accepts.

    About ``training`` labelled documents are used, chosen by a hash of the id; classes are weighted back to
    their shares. An id with several labels is toxic if one says so; null labels do not count. With one
    class only, or none, every text gets the smoothed share of toxic labels.
    """
    rows = labels.where(F.lit(True) if allowed is None else allowed).where(F.col(f"`{label_col}`").isNotNull())
    rows = rows.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max((F.col(f"`{label_col}`") > 0).cast("int")).alias("y")).where("id is not null")
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    empty = Model(np.full(DIMENSIONS, -1, np.int32), np.zeros(0), float(np.log((toxic + 1) / (clean + 1))))
    if not toxic or not clean:
        return empty
    take = {1: min(1.0, training / 2 / toxic)}
    take[0] = min(1.0, (training - take[1] * toxic) / clean)
    chosen = F.broadcast(rows.where(unit_hash("id") < F.when(F.col("y") == 1, take[1]).otherwise(take[0])))  # about ``training`` rows
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("t")).join(chosen, "id").select("y", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, DIMENSIONS), np.int64)
        for batch in slices(batches):
            for y, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[y, np.unique(features_of(raw.decode() if raw else ""))] += 1
        yield chunk_rows(dict(enumerate(total.reshape(CHUNKS, -1))))

    clean_in, toxic_in = summed_chunks(texts.mapInArrow(count, CHUNK_SCHEMA), 2 * DIMENSIONS, CHUNKS).reshape(2, -1)
    taken = take[1] * toxic, take[0] * clean
    ratio = np.log((toxic_in + 1) / (taken[0] + 2)) - np.log((clean_in + 1) / (taken[1] + 2))
    both = toxic_in + clean_in
    share = both / sum(taken)
    expected = share * taken[0]
    telling = (toxic_in - expected) ** 2 / np.maximum(expected * (1 - np.minimum(share, 0.999)), 1e-9) * (both >= LEAST)
    best = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    best = best[telling[best] > 0]
    slot = np.full(DIMENSIONS, -1, np.int32)
    slot[best] = np.arange(len(best))
    model = Model(slot, np.zeros(len(best)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shared.value.present(raw.decode() if raw else "").astype(np.int32).tobytes() for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["y", "slots"])

    found = sorted((r.y, bytes(r.slots)) for r in texts.mapInArrow(present, "y int, slots binary").collect())
    rows_ = [np.frombuffer(s, np.int32) for _, s in found]
    y = np.array([y for y, _ in found], float)
    if not len(y) or y.min() == y.max() or not len(best):
        return empty
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows_])))
    weights, bias = regression(offsets, np.concatenate(rows_), ratio[best], y, np.where(y == 1, 1 / take[1], 1 / take[0]))
    return Model(slot, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", result: str = "_toxic") -> DataFrame:
    """``docs`` with one more column, the score from 0 to 1; null and empty texts get the model's base rate.
    A column that has the result's name gives way to it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = arrow_column(
        lambda texts, model: [model.score(raw and raw.decode()) for raw in texts], "double", pa.float64(), lambda: shared.value
    )
    return docs.withColumn(result, column(utf8(text_col)))
