"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. Each text becomes the set of its distinct word n-grams (as 64-bit hashes). A first pass writes
   each row's set size and fingerprint, and adds up a fixed-size sketch of how many sets hold an n-gram.
   Texts with equal sets are one *node* from here on.
2. A second pass orders each set rarest first by the sketch (any one order is right; this one keeps common
   n-grams out of prefixes) and emits the prefix: the n-grams of which two linked sets share one at least.
3. Nodes that share a prefix n-gram are candidates if size and position allow it. All pairs of a
   large group are never emitted: in each of a few rounds every node is compared with one leader, the
   most typical node among the holders of its n-grams, and n-grams whose nodes already lie in one
   component drop out. Only what is then left, n-grams that hold nodes of different components, is
   joined in full, so no component is missed. Holders that no other holder may be linked with drop out too.
4. Candidates meet with their sets' signatures, about 3 bits an n-gram, which bound from below how the sets
   differ (the suffix filter). Texts in part alike end here.
5. A pair that is left is verified once on the two whole texts.

Texts move only for pairs about as similar as asked. Intermediate tables lie in the shared folder; a lost
executor costs its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_column, materialize, slices, utf8
from .components import components

WORDS = 4  # words of an n-gram
PERCENT = 85  # smallest similarity of linked sets
BUCKET_BITS = 21  # of the sketch: 2 MB from each task, 2 MB broadcast
CHUNKS = 64
ROUNDS = 2  # star rounds before the rest is joined in full
SMALL = 1_000_000  # ids that may be broadcast (16 MB); more are joined by a shuffle
BLOCK = 1 << 20  # bytes of a text hashed at a time

_BASE, _MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def _hashes_of_block(block: bytes) -> np.ndarray:
    if not _tables:
        _tables["up"] = _powers(int(_BASE), BLOCK + 1)
        _tables["down"] = _powers(pow(int(_BASE), -1, 1 << 64), BLOCK + 1)
    codes = np.frombuffer(block, np.uint8)
    edges = np.diff(np.concatenate(([True], _SPACE[codes], [True])).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _tables["up"][: len(codes)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _tables["down"][starts]
    return _mixed(h + (ends - starts).astype(np.uint64) * _STEP)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each blank-separated word, ASCII letters lower-cased."""
    text = text.lower()
    if len(text) <= BLOCK:
        return _hashes_of_block(text)
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text) and not (cut := max(text.rfind(bytes([s]), at, end) for s in (32, 9, 10, 11, 12, 13))) <= at:
            end = cut
        elif end < len(text):  # a word longer than a block
            end = min((p for p in (text.find(bytes([s]), end) for s in (32, 9, 10, 11, 12, 13)) if p >= 0), default=len(text))
            word = text[at:end].strip()
            parts.append(np.array([int.from_bytes(blake2b(word, digest_size=8).digest(), "little")] if word else [], np.uint64))
            at = end
            continue
        parts.append(_hashes_of_block(text[at:end]))
        at = end
    return np.concatenate(parts)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text; the whole text is one n-gram if it has fewer words."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    n = min(words, len(h))
    z = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        z = z * _BASE + h[k : len(h) - n + 1 + k]
    z = _mixed(z)
    z.sort()
    return z[np.concatenate(([True], z[1:] != z[:-1]))]


def fingerprint(z: np.ndarray) -> tuple[int, int]:
    digest = blake2b(z.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def signature(z: np.ndarray) -> bytes:
    """Of 2 to 4 times as many hash classes as the set has n-grams (64 at least), whether each holds an odd number."""
    bits = max(64, 1 << (2 * len(z) - 1).bit_length())
    return np.packbits(np.bincount((z & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """N-grams that only one of the two sets has, at least: one in each class that is odd in one set only."""
    a, b = sorted((a, b), key=len)
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while bits > 8 * len(a):  # two classes become one
        bits //= 2
        y = (y >> bits) ^ (y & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def survey(docs: DataFrame, words: int) -> DataFrame:
    """Rows of kind 0: id, node, check, n and signature of each document; of kind 1: chunks of the sketch.

    Signatures and chunks are in ``cells``.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        names, id_type = ["kind", "doc_id", "node", "other", "n", "cells"], None
        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            nodes, others, sizes, held, signatures = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                z = shingles(text, words)
                a, b = fingerprint(z)
                nodes.append(a)
                others.append(b)
                sizes.append(len(z))
                signatures.append(signature(z) if len(z) else None)
                held.append((z >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            np.add.at(counts, np.concatenate(held), 1)
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), batch.column(0), pa.array(nodes, pa.int64()), pa.array(others, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())], names
            )
        if id_type is not None and counts.any():
            cells = np.minimum(counts, 255).astype(np.uint8).reshape(CHUNKS, -1)
            nothing = pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * CHUNKS, pa.int32()), pa.nulls(CHUNKS, id_type), pa.array(range(CHUNKS), pa.int64()), nothing, nothing, pa.array([c.tobytes() for c in cells], pa.binary())], names
            )

    return docs.mapInArrow(run, f"kind int, doc_id {kind.simpleString()}, node bigint, other bigint, n bigint, cells binary")


def rarity(surveyed: DataFrame) -> np.ndarray:
    """Level (log2 of how many sets) of every bucket of the sketch: 2 MB, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(cells, np.uint8).astype(np.uint64)
        for chunk, total in sums.items():
            level = np.ceil(np.log2(total.astype(float) + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"node": [chunk], "cells": [level.tobytes()]}, schema=pa.schema([("node", pa.int64()), ("cells", pa.binary())]))

    rows = surveyed.where("kind = 1").select("node", "cells").repartition(CHUNKS, "node").mapInArrow(add, "node bigint, cells binary")
    out = np.zeros((CHUNKS, (1 << BUCKET_BITS) // CHUNKS), np.uint8)
    for r in rows.collect():
        out[r.node] = np.frombuffer(bytes(r.cells), np.uint8)
    return out.ravel()


def prefixes(docs: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """(token, node, size_place) of every n-gram in a set's rare-first prefix.

    ``size_place`` packs how common the prefix's n-grams are (8 bits), the set's size and the place (28 bits each).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("size_place", pa.int64())])
        seen: set[int] = set()  # sets of this task, so that its copies are emitted once
        for batch in slices(batches):
            tokens, nodes, places = [], [], []
            for text in batch.column(0).to_pylist():
                z = shingles(text, words)
                if not len(z):
                    continue
                node, _ = fingerprint(z)
                if node in seen:
                    continue
                if len(seen) < 1 << 17:
                    seen.add(node)
                m = prefix_size(len(z), percent)
                order = np.argsort(level[(z >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)], kind="stable")[:m]
                tokens.append(z[order].view(np.int64))
                nodes.append(np.full(m, node, np.int64))
                typical = int(level[(z[order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].mean() * 2)  # below 128
                places.append((typical << 56) + (len(z) << 28) + np.arange(m, dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (tokens, nodes, places)], schema=schema)

    return docs.select("t").mapInArrow(run, "token bigint, node bigint, size_place bigint")


_LOW = (1 << 28) - 1


def set_size(entry: str) -> Column:
    return F.shiftright(f"{entry}size_place", 28).bitwiseAND(F.lit(_LOW))


def sizes_allow(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def overlap(na, nb, percent: int):
    """What linked sets have in common, at least."""
    return F.ceil(percent * (na + nb) / F.lit(100 + percent))


def possible(a: str, b: str, percent: int) -> Column:
    """Whether two prefix entries with one n-gram, the first that their sets share, may belong to linked sets."""
    na, nb = set_size(a), set_size(b)
    pa_, pb = (F.col(f"{s}size_place").bitwiseAND(F.lit(_LOW)) for s in (a, b))
    return sizes_allow(na, nb, percent) & (F.lit(1) + F.least(na - pa_ - 1, nb - pb - 1) >= overlap(na, nb, percent))


def rank(turn: int, entry: str = "") -> list[Column]:
    """The leader has the most common prefix: copies with changes have rare n-grams of their own."""
    return [F.shiftright(f"{entry}size_place", 56).alias("typical"), F.xxhash64(F.lit(turn), f"{entry}node").alias("order"), F.col(f"{entry}node").alias("node")]


def undecided(entries: DataFrame, comps: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """Entries of n-grams whose nodes lie in more than one component, with the n-gram's leader.

    A node that size bars from all other holders has no entry, two holders that may not be linked neither.
    """
    if comps is None:
        placed = entries.withColumn("component", F.col("node"))
    else:
        placed = entries.select(*ENTRY).join(checked_broadcast(comps), "node", "left").withColumn("component", F.coalesce("component", "node"))
    holders = Window.partitionBy("token")
    by_size = holders.orderBy("n", "node")
    n, near = F.col("n"), [f"{s}size_place" for s in ("before_", "after_")]
    held = (
        placed.repartition("token")
        .withColumn("n", set_size(""))
        .withColumn("lo", F.min("component").over(holders))
        .withColumn("hi", F.max("component").over(holders))
        .withColumn("holders", F.count("*").over(holders))
        .withColumn("l", F.max(F.struct(*rank(turn), "size_place", "component")).over(holders))
        .where("lo < hi")
        .withColumn(near[0], F.lag("size_place").over(by_size))
        .withColumn(near[1], F.lead("size_place").over(by_size))
        .withColumn("other_size_place", F.coalesce(*near))
    )
    some = F.coalesce(sizes_allow(n, set_size("before_"), percent), F.lit(False)) | F.coalesce(sizes_allow(n, set_size("after_"), percent), F.lit(False))
    return held.where(F.when(F.col("holders") == 2, possible("", "other_", percent)).otherwise(some)).select(
        *ENTRY, "component", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("node", "size_place", "component")]
    )


ENTRY = ("token", "node", "size_place")


def star_pairs(entries: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each node with one leader of its n-grams, the most typical that it may be linked with."""
    lead = entries.where((F.col("component") != F.col("l_component")) & possible("", "l_", percent))
    best = lead.groupBy("node").agg(F.max(F.struct(*rank(turn, "l_"))).alias("b"))
    return best.select(F.least("node", "b.node").alias("x"), F.greatest("node", "b.node").alias("y")).distinct()


def all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes of different components that share an n-gram and may be linked.

    One node of such a pair at least lies outside the component of the n-gram's leader: only those look for others.
    """
    a, b = (
        entries.select(*[F.col(c).alias(f"{s}_{c}") for c in (*ENTRY, "component")], (F.col("component") != F.col("l_component")).alias(f"{s}_outside"))
        for s in ("a", "b")
    )
    once = ~F.col("b_outside") | (F.col("a_node") < F.col("b_node"))
    rule = (F.col("a_token") == F.col("b_token")) & (F.col("a_component") != F.col("b_component")) & once
    both = a.where("a_outside").join(b, rule & possible("a_", "b_", percent))
    return both.select(F.least("a_node", "b_node").alias("x"), F.greatest("a_node", "b_node").alias("y")).distinct()


def checked_broadcast(table: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is small enough."""
    return F.broadcast(table) if table.limit(SMALL + 1).count() <= SMALL else table


def ends(pairs: DataFrame) -> DataFrame:
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    return checked_broadcast(materialize(wanted, "wanted"))


def plausible(pairs: DataFrame, surveyed: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose signatures allow a link: those that differ too much go before any text moves."""
    marks = surveyed.where("kind = 0").select("node", "n", "cells").join(ends(pairs), "node", "left_semi").dropDuplicates(["node"])
    x, y = (marks.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("cells").alias(f"c{s}")) for s in ("x", "y"))
    both = pairs.join(y, "y").join(x, "x")
    most = F.col("nx") + F.col("ny") - 2 * overlap(F.col("nx"), F.col("ny"), percent)

    def near(rows: list) -> list[bool]:
        return [least_difference(r["cx"], r["cy"]) <= r["most"] for r in rows]

    return both.where(arrow_column(near, "boolean", pa.bool_())(F.struct("cx", "cy", most.alias("most")))).select("x", "y")


def verified(pairs: DataFrame, docs: DataFrame, homes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole texts are similar enough. ``homes``: a document of each node."""
    wanted = materialize(homes.join(ends(pairs), "node").select("doc_id", "node"), "wanted")
    texts = docs.join(checked_broadcast(wanted), "doc_id").select("node", "t")
    x = texts.select(F.col("node").alias("x"), F.col("t").alias("tx"))
    y = texts.select(F.col("node").alias("y"), F.col("t").alias("ty"))
    both = pairs.join(y, "y").join(x, "x")

    def similar(rows: list) -> list[bool]:
        out, last = [], (None, None)
        for r in rows:
            if last[0] != r["tx"]:
                last = (r["tx"], shingles(r["tx"], words))
            a, b = last[1], shingles(r["ty"], words)
            # Rows that share a document's id may have other texts than the node's.
            same = (fingerprint(a)[0], fingerprint(b)[0]) == (r["x"], r["y"])
            shared = len(np.intersect1d(a, b, assume_unique=True)) if same else 0
            out.append(bool(shared and 100 * shared >= percent * (len(a) + len(b) - shared)))
        return out

    ok = arrow_column(similar, "boolean", pa.bool_())(F.struct("x", "y", "tx", "ty"))
    return both.where(ok).select("x", "y").distinct()


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id in its component).

    Two texts link when 100 * |intersection| >= percent * |union| of their n-gram sets; texts with equal
    sets, exact copies too, always do. Null, empty and wordless texts have no n-gram and no link. Rows with
    a null id take no part and have a null component; rows with the same id but other texts are documents
    of their own. An empty table gives an empty result.
    """
    sc = documents.sparkSession.sparkContext
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(text_col).alias("t"))
    surveyed = materialize(survey(docs, words), "survey")
    rows = surveyed.where("kind = 0").select("doc_id", "node", "other", "n")
    classes = rows.where("n > 0 and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("other").alias("o1"), F.max("other").alias("o2")
    )
    classes = materialize(classes, "classes")
    if classes.where("o1 <> o2").limit(1).count():  # about once in 2^64 / rows^2 corpora
        raise ValueError("two sets share a 64-bit fingerprint; change the constants of the hash")
    homes = classes.select("node", "doc_id")
    levels = sc.broadcast(rarity(surveyed))
    # Equal sets met by several tasks stay until the first shuffle; most n-grams, those of one set, go there.
    entries = prefixes(docs.where("doc_id is not null"), levels, words, percent).repartition("token").dropDuplicates(["token", "node"])
    links, comps, tried = None, None, None
    for turn in range(ROUNDS + 1):
        entries = materialize(undecided(entries, comps, turn, percent), "entries")
        pairs = star_pairs(entries, percent, turn) if turn < ROUNDS else all_pairs(entries, percent)
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        likely = materialize(plausible(pairs, surveyed, percent), "likely")
        if not likely.limit(1).count():
            continue
        found = materialize(verified(likely, docs, homes, words, percent), "links")
        links = found if links is None else links.unionByName(found)
        comps = materialize(components(links), "components")
    named = homes.withColumn("component", F.col("node"))
    if comps is not None:
        named = homes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    with_text = rows.where("n > 0 and doc_id is not null").join(named, "node")
    without = rows.where("n = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return with_text.select(*out).unionByName(without.select(*out))
