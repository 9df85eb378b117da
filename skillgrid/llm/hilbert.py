"""Nearest neighbours by shifted space-filling curves.

Each of several curves orders all vectors by the Hilbert key of a random projection to a few dimensions,
shifted at random. Keys of a curve are cut into windows at approximate quantiles, a range partitioning that
needs no sort; near vectors mostly lie in the same or adjoining windows of some curve. A query is compared,
by exact distances, with the vectors in its own and the two adjoining windows of every curve, and
the best over all curves remain.

Equal vectors are one point with its smallest ids, so a vector repeated any number of times costs as much as
one. Windows larger than a task should hold are split into salted parts that see the same queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CURVES, PROJECTED, BITS = 32, 8, 7  # 56-bit keys
WINDOWS = 40  # of a curve; a query sees three of them
PART = 20_000  # vectors of a window in one task
QUERY_PART = 5_000  # queries of a window in one task


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points with whole coordinates below 2**bits (Skilling's transposition)."""
    x = cells.astype(np.uint32).copy()
    n, d = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(d):
            high = (x[:, i] & np.uint32(q)) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p).astype(np.uint32)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, d - 1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[:, i] >> np.uint32(b) & np.uint32(1)).astype(np.int64)
    return key


@dataclass
class Curves:
    """Random projections and shifts, scaled by the data's mean and spread."""

    axes: np.ndarray  # curve, dimension, projected
    low: np.ndarray  # curve, projected
    width: np.ndarray

    @staticmethod
    def of(mean: np.ndarray, variance: np.ndarray, curves: int, seed: int) -> Curves:
        rng = np.random.default_rng(seed)
        d = len(mean)
        axes = rng.normal(size=(curves, d, PROJECTED)) / np.sqrt(d)
        centre = np.einsum("d,cdp->cp", mean, axes)
        spread = np.sqrt(np.einsum("d,cdp->cp", variance, axes * axes)) + 1e-300
        # Eight standard deviations in half of the range, shifted by up to the other half.
        return Curves(axes, centre - (4 + 8 * rng.uniform(size=centre.shape)) * spread, 16 * spread)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Keys by vector and curve."""
        out = []
        for axes, low, width in zip(self.axes, self.low, self.width):
            at = (np.einsum("nd,dp->np", vectors, axes) - low) / width
            out.append(hilbert_keys(np.clip((at * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1), BITS))
        return np.stack(out, axis=1) if len(vectors) else np.empty((0, len(self.axes)), np.int64)


def usable(vector: str) -> Column:
    """Neither null nor zero, every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_points(rows: DataFrame, k: int) -> DataFrame:
    """Equal vectors as one point: point (smallest id), ids (the k + 1 smallest), asked (whether a query is among them).

    Each task keeps its k + 1 smallest ids of a vector before anything is shuffled.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for batch in batches:
            frame = pd.DataFrame({"id": batch.column(0).to_pandas(), "asked": batch.column(2).to_pandas(), "v": batch.column(1).to_pylist()})
            frame["key"] = [np.array(v, np.float64).tobytes() for v in frame.v]
            asked = frame.groupby("key", sort=False).asked.transform("any")
            kept = frame.assign(asked=asked).sort_values("id").groupby("key", sort=False).head(k + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept.key, pa.binary()), pa.array(kept.id, pa.int64()), pa.array(kept.asked, pa.bool_())], ["v", "id", "asked"]
            )

    kept = rows.mapInArrow(first, "v binary, id bigint, asked boolean")
    salted = kept.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(32)).alias("salt")).agg(
        F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"), F.max("asked").alias("asked")
    )
    one = salted.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"), F.max("asked").alias("asked"))
    return one.select(F.element_at("ids", 1).alias("point"), "ids", "asked", "v")


def nearest_of(queries: np.ndarray, points: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact distances of its k nearest points, and all ties of the last."""
    out = []
    norms = np.einsum("ij,ij->i", points, points)
    for start in range(0, len(queries), 64):
        part = queries[start : start + 64]
        rough = norms[None] - 2 * np.einsum("qd,pd->qp", part, points, optimize=True)
        for q, row in zip(part, rough):
            slack = 1e-9 * (abs(row).max() + float(q @ q) + 1)
            cut = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1] + slack
            near = np.flatnonzero(row <= cut)
            exact = np.sqrt(((points[near] - q) ** 2).sum(axis=1))
            last = np.partition(exact, min(k, len(exact)) - 1)[min(k, len(exact)) - 1]
            keep = exact <= last
            out.append((near[keep], exact[keep]))
    return out


def nearest(
    vectors: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    curves: int = CURVES, windows: int = WINDOWS, seed: int = 17,
) -> DataFrame:
    """The k nearest rows of every row that ``asked`` accepts: query_id, rank, vec_id, score (Euclidean distance).

    Nearest first, ties to the smaller id; a row is no neighbour of its own. Rows with a null id or an
    unusable vector take no part, nor do those whose dimension is not the most frequent one. Rows that
    repeat an id and vector count once. Fewer rows than k give fewer neighbours, an empty table none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & usable("v"))
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return none
    rows = rows.where(F.size("v") == common.d)
    moments = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("m"), F.var_pop("x").alias("s")).orderBy("at").collect()
    shape = Curves.of(np.array([r.m for r in moments]), np.array([r.s for r in moments]), curves, seed)
    points = materialize(distinct_points(rows, k), "points")
    total = points.count()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = shape.keys(np.stack([np.frombuffer(v, np.float64) for v in batch.column(2).to_pylist()]))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), curves)), batch.column(1).take(pa.array(np.repeat(np.arange(n), curves))),
                 pa.array(np.tile(np.arange(curves, dtype=np.int64), n)), pa.array(found.ravel())],
                ["point", "asked", "curve", "key"],
            )

    keys = points.select("point", "asked", "v").mapInArrow(keyed, "point bigint, asked boolean, curve bigint, key bigint")
    keys = materialize(keys, "keys")
    cuts = [i / windows for i in range(1, windows)]
    # Curves x windows numbers, whatever the number of vectors.
    bounds = keys.groupBy("curve").agg(F.percentile_approx("key", cuts, 10_000).alias("cuts"))
    placed = keys.join(F.broadcast(bounds), "curve").withColumn("window", F.aggregate("cuts", F.lit(0), lambda n, c: n + (F.col("key") > c).cast("int")))
    parts, query_parts = max(1, -(-total // (windows * PART))), max(1, -(-3 * total // (100 * windows * QUERY_PART)))
    own = F.pmod(F.xxhash64("point"), F.lit(parts)).alias("part")
    asked_in = F.explode(F.sequence(F.col("window") - 1, F.col("window") + 1)).alias("window")
    stored = placed.select("point", "curve", "window", own, F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("qpart"))
    seekers = placed.where("asked").select("point", "curve", asked_in, F.pmod(F.xxhash64("point"), F.lit(query_parts)).cast("int").alias("qpart"))
    seekers = seekers.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"))
    body = points.select("point", "v")
    where = ["curve", "window", "part", "qpart"]

    def compare(queries, group):
        import pandas as pd

        if not len(queries) or not len(group):
            return pd.DataFrame({"query": np.empty(0, np.int64), "point": np.empty(0, np.int64), "score": np.empty(0)})
        q, p = (np.stack([np.frombuffer(v, np.float64) for v in column]) for column in (queries.q_v, group.v))
        ids, found = group.point.to_numpy(), nearest_of(q, p, k + 1)
        return pd.DataFrame({
            "query": np.repeat(queries["query"].to_numpy(), [len(near) for near, _ in found]),
            "point": np.concatenate([ids[near] for near, _ in found]),
            "score": np.concatenate([far for _, far in found]),
        })

    own_names = seekers.select(F.col("point").alias("query"), *[F.col(c).alias(f"q_{c}") for c in where])
    bodies = body.select(F.col("point").alias("query"), F.col("v").alias("q_v"))
    left = own_names.join(bodies, "query").groupBy(*[f"q_{c}" for c in where])
    right = stored.join(body, "point").groupBy(*where)
    pairs = left.cogroup(right).applyInPandas(compare, "query bigint, point bigint, score double").distinct()
    order = Window.partitionBy("query").orderBy("score", "point")
    best = pairs.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    # A point stands for its equal vectors: their smallest ids, at the same distance.
    best = best.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    lists = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("found")
    )
    # Back to the rows that asked: those with an equal vector share a list, less their own id.
    asking = rows.where("asked").select(F.col("id").alias("query_id"), "v").distinct()
    first = points.where("asked").select(F.col("point").alias("query"), "v").join(lists, "query").select(F.col("v").alias("bytes"), "found")

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array(v, np.float64).tobytes() for v in batch.column(1).to_pylist()], pa.binary())], ["query_id", "bytes"])

    answers = asking.mapInArrow(bytes_of, "query_id bigint, bytes binary").join(first, "bytes")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")
    )
