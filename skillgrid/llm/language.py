"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed character 1- to 3-grams, of length 1. Each language's vectors, from a
bounded sample, are clustered into a few centroids by spherical k-means, one task per language. A text gets
the language of the centroid with the largest cosine, and is rejected if even that is too far away.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_SCHEMA, arrow_column, chunk_rows, free_name, letter_codes, materialize, ngram_hashes, slices, summed_chunks, unit_hash, utf8

SIZES, BITS = (1, 2, 3), 13
DIMENSIONS = 1 << BITS
PER_LANGUAGE = 1000  # sampled training texts of a language, about: the bound of a clustering task
BLOCK = 2000  # centroids broadcast at a time (64 MB); more are compared in further passes
CENTROIDS = 4
REJECT = 0.5  # of the smallest cosine between a centroid and its own training texts
UNKNOWN = "und"


def counts_of(text: str) -> np.ndarray:
    return np.bincount(ngram_hashes(letter_codes(text), SIZES, BITS), minlength=DIMENSIONS)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def unit_vector(text: str, idf: np.ndarray) -> np.ndarray:
    v = (np.log1p(counts_of(text)) * idf).astype(np.float32)
    return v / max(float(np.sqrt((v * v).sum())), 1e-12)


def k_means(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts: centroids of length 1, and the nearest centroid of each vector."""
    mean = vectors.mean(axis=0)
    centroids = [vectors[np.argmax(np.einsum("ij,j->i", vectors, mean))]]
    near = np.einsum("ij,j->i", vectors, centroids[0])
    while len(centroids) < min(k, len(vectors)):
        centroids.append(vectors[np.argmin(near)])
        near = np.maximum(near, np.einsum("ij,j->i", vectors, centroids[-1]))
    centroids = np.array(centroids)
    for _ in range(rounds):
        best = np.argmax(np.stack([np.einsum("ij,j->i", vectors, c) for c in centroids]), axis=0)
        fresh = np.stack([vectors[best == j].mean(axis=0) if (best == j).any() else centroids[j] for j in range(len(centroids))])
        fresh /= np.maximum(np.sqrt((fresh * fresh).sum(axis=1, keepdims=True)), 1e-12)
        if np.allclose(fresh, centroids, atol=1e-6):
            break
        centroids = fresh
    return centroids, np.argmax(np.stack([np.einsum("ij,j->i", vectors, c) for c in centroids]), axis=0)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # a row each
    languages: list[str]  # of the rows
    reach: np.ndarray  # smallest accepted cosine of each row

    def blocks(self, size: int) -> list["Model"]:
        """The model in parts of ``size`` centroids."""
        starts = range(0, len(self.languages), size)
        return [Model(self.idf, self.centroids[k : k + size], self.languages[k : k + size], self.reach[k : k + size]) for k in starts]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        if not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        cosines = np.einsum("ij,j->i", self.centroids, unit_vector(text, self.idf))
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, score < self.reach[best]


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", allowed: Column | None = None,
    per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, reject: float = REJECT,
) -> Model | None:
    """A model from the labelled rows that ``allowed`` accepts; None if no labelled row has a letter.

    About ``per_language`` rows of each language are used, chosen by a hash of the id; rows without text, letters
    or label are left out. Every label is learned; the model grows with their number (131 kB each with four centroids).
    """
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("id"), (F.lit(True) if allowed is None else allowed).alias("ok"))
    rows = rows.where("ok and lang is not null and text rlike '\\\\p{L}'")
    shares = F.broadcast(rows.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share")))  # a row for each label
    sample = rows.join(shares, "lang").where(unit_hash("id") < F.col("share")).select("lang", utf8("text").alias("t"))

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in slices(batches):
            for raw in batch.column(1).to_pylist():
                total[:-1] += counts_of(raw.decode()) > 0
                total[-1] += 1
        yield chunk_rows({0: total})

    seen = summed_chunks(sample.mapInArrow(document_counts, CHUNK_SCHEMA), DIMENSIONS + 1, 1)
    if not seen[-1]:
        return None
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1

    def cluster(group):
        import pandas as pd  # here, so that workers of other stages do without it

        # In order of the text, so that the result does not depend on how rows arrive.
        vectors = np.stack([unit_vector(bytes(t).decode(), idf) for t in sorted(group.t)])
        found, nearest = k_means(vectors, centroids)
        own = np.einsum("ij,ij->i", vectors, found[nearest])
        # Also texts at the rim of another centroid of the language count for a centroid's reach.
        reach = [reject * float(own.min())] * len(found)
        return pd.DataFrame({"lang": group.lang.iloc[0], "reach": reach, "centroid": [c.astype(np.float32).tobytes() for c in found]})

    learned = sample.groupBy("lang").applyInPandas(cluster, "lang string, reach double, centroid binary").collect()
    learned = sorted(learned, key=lambda r: (r.lang, bytes(r.centroid)))
    matrix = np.stack([np.frombuffer(bytes(r.centroid), np.float32) for r in learned])
    return Model(idf, matrix, [r.lang for r in learned], np.array([r.reach for r in learned]))


RESULT = "struct<lang:string,score:double,rejected:boolean>"
_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def detect(docs: DataFrame, model: Model | None, text_col: str = "text", result: str = "_lang") -> DataFrame:
    """``docs`` with one more column, a struct of lang, score (cosine, 0 to 1) and rejected.

    A text that is null or has no letter is ``und``, score 0, rejected; so is every text without a model.
    Any other text gets the nearest learned language, rejected or not. Repeated rows are kept. A
    column that has the result's name gives way to it.
    """
    sc = docs.sparkSession.sparkContext
    blocks = model.blocks(BLOCK) if model else [None]
    out = docs
    for block in blocks:
        shared = sc.broadcast(block)

        def predict(texts: list, model: Model | None) -> list[dict]:
            found = []
            for raw in texts:
                lang, score, rejected = model.predict(raw and raw.decode()) if model else (UNKNOWN, 0.0, True)
                found.append({"lang": lang, "score": score, "rejected": rejected})
            return found

        column = arrow_column(predict, RESULT, _RESULT, lambda shared=shared: shared.value)(utf8(text_col))
        if block is blocks[0]:
            out = out.withColumn(result, column)
        else:
            more = free_name(out, "_more")
            nearer = F.col(f"`{more}`.score") > F.col(f"`{result}`.score")  # of equals the first
            best = F.when(nearer, F.col(f"`{more}`")).otherwise(F.col(f"`{result}`"))
            out = out.withColumn(more, column).withColumn(result, best).drop(more)
        if len(blocks) > 1:
            out = materialize(out, "languages")  # one block in a worker at a time
    return out
