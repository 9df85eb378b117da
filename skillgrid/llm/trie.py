"""Prefix trie of conversations in minimal-perfect-hash node tables.

1. Turns of a conversation, in order, are read as a stream that emits a chained 128-bit digest for each prefix. A
   grouping by digest enumerates the nodes, with their members' count and smallest id, their parent's digest and an upper
   bound of the nodes below them (the turns that members still have).
2. Nodes are dealt to tiers by that bound: tier 1 up to ``limit``, tier 2 up to its square, and so on; the root
   is in the last. A node's shard is headed by its highest ancestor of the same tier, so that a tier-1 shard holds at
   most ``limit`` nodes and a higher one about as many times the longest conversation, however hot a prefix is.
3. A task takes whole shards. It gives its nodes the slots of a minimal perfect hash of their digests (levels of bits in which
   a key stands alone), verifies that every slot holds its own key, scatters counts into flat arrays by slot and adds them
   up along an array of parent slots, deepest nodes first.
4. What a shard's head has gathered is added up by parent before the next tier starts: a node with millions of children
   receives one row.

Tables between the steps lie in the shared folder. There is one job for each tier.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, utf8

LIMIT = 1 << 11  # nodes of a tier-1 shard
BATCH = 1 << 16  # rows after which a task closes its table at the end of a shard
CHUNK = 1 << 16  # bytes of ids that are put together before they are hashed
LOAD = 1.6  # bits for each key on a level of the hash
BROADCAST = 1_000_000  # nodes above tier 1 that may be broadcast (32 MB); more are joined by a shuffle

ROOT = (0, 0)
NODE = ["hi", "lo"]

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shared_turns(turns: DataFrame, group: int, most: int, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations that begin as the first of their group does.

    The first ``h`` turns of conversation ``c`` come from conversation ``c - c % group`` (all of them, if it has
    fewer; none, if there is no such conversation), ``h`` being the unsigned crc32 of the decimal ``c`` modulo ``most + 1``;
    its own turns after its first ``h`` follow. Returns one row for each conversation with ``part`` 0 and the number of its turns
    ``len``, and one for each turn: conv, part, pos, role, text. See :func:`trie` for the order of turns and nulls.
    """
    given = ordered(turns, id_col, turn_col, role_col, text_col)
    known = given.groupBy("conv").agg(F.count("*").alias("n_own"))
    h = (F.crc32(F.col("conv").cast("string")) % (most + 1)).cast("bigint")
    known = known.select("conv", "n_own", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    first = known.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    known = materialize(known.join(first, "base", "left"), "conversations")

    begun = given.where((F.col("pos") <= most) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    begun = known.where("h > 0 and n_base > 0").select("conv", "base", "h").join(begun, "base").where("pos <= h")
    own = given.where(F.col("pos") > (F.crc32(F.col("conv").cast("string")) % (most + 1)))
    n = F.least("h", F.coalesce("n_base", F.lit(0))) + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    heads = known.select("conv", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("pos"), n.alias("len"))
    out = heads.unionByName(begun.select("conv", F.lit(1).alias("part"), "pos", "role", "text"), allowMissingColumns=True)
    return out.unionByName(own.select("conv", F.lit(2).alias("part"), "pos", "role", "text"), allowMissingColumns=True)


def plain_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations as they are, in the form of :func:`shared_turns`."""
    given = ordered(turns, id_col, turn_col, role_col, text_col)
    heads = given.groupBy("conv").agg(F.count("*").alias("len")).select("conv", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("pos"), "len")
    return heads.unionByName(given.select("conv", F.lit(1).alias("part"), "pos", "role", "text"), allowMissingColumns=True)


def ordered(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Written turns (conv, pos, role, text), numbered from 1 within a conversation."""
    empty = F.lit(b"")
    rows = turns.select(
        F.col(f"`{id_col}`").cast("bigint").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(utf8(role_col), empty).alias("role"),
        F.coalesce(utf8(text_col), empty).alias("text"),
    ).where("conv is not null")
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return materialize(rows.withColumn("pos", F.row_number().over(order).cast("bigint")).drop("turn"), "turns")


# --- prefixes

_PREFIX = pa.schema([(n, pa.int64()) for n in ("conv", "depth", "hi", "lo", "up_hi", "up_lo", "words", "below")])
PREFIX = "conv bigint, depth bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, words bigint, below bigint"


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """One row for each prefix of each conversation: its digest, that of the prefix before, words of the last turn,
    and ``below``, the turns that follow."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depth, left, key, digest = 0, 0, ROOT, bytes(16)
        for batch in batches:
            out = []
            for conv, part, n, role, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if part == 0:
                    depth, left, key, digest = 0, n, ROOT, bytes(16)
                    out.append((conv, 0, *ROOT, *ROOT, 0, left))
                    continue
                digest = hashlib.blake2b(digest + struct.pack("<q", len(role)) + role + text, digest_size=16).digest()
                up, key = key, struct.unpack("<qq", digest)
                depth, left = depth + 1, left - 1
                out.append((conv, depth, *key, *up, len(text.split()), left))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 8)], schema=_PREFIX)

    rows = rebuilt.repartition("conv").sortWithinPartitions("conv", "part", "pos").select("conv", "part", "len", "role", "text")
    return rows.mapInArrow(chain, PREFIX)


def nodes_of(rows: DataFrame) -> DataFrame:
    """Distinct prefixes; rows of one digest must agree in depth, parent and words."""
    same = [F.min(c).alias(c) for c in ("depth", "up_hi", "up_lo", "words")]
    agree = [F.min(c) == F.max(c) for c in ("depth", "up_hi", "up_lo", "words")]
    verified = agree[0] & agree[1] & agree[2] & agree[3]
    found = rows.groupBy(*NODE).agg(*same, F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum("below").alias("weight"), verified.alias("agree"))
    checked = F.when(F.col("agree"), F.col("conv")).otherwise(F.raise_error(F.lit("two prefixes have one digest")))
    return found.withColumn("conv", checked).drop("agree")


# --- shards

def tier_of(weight: Column, depth: Column, limit: int, tiers: int) -> Column:
    """The first tier whose bound, ``limit`` to its power, a node's weight does not exceed; the root is in the last."""
    tier = F.lit(tiers)
    for t in range(tiers - 1, 0, -1):
        tier = F.when(weight <= limit**t, t).otherwise(tier)
    return F.when(depth == 0, tiers).otherwise(tier)


def checked_broadcast(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST + 1).count() <= BROADCAST else table


def sharded(rows: DataFrame, nodes: DataFrame, tiers: int) -> DataFrame:
    """Nodes (with ``tier``) and the digest ``head_hi, head_lo`` of their shard's head."""
    # How deep the prefixes of a higher tier reach in a conversation: heads of tier t are one turn deeper than those above t.
    high = checked_broadcast(materialize(nodes.where("tier > 1 and depth > 0").select(*NODE, "tier"), "high"))
    depths = rows.where("depth > 0").select("conv", "depth", *NODE).join(high, NODE)
    cut = depths.groupBy("conv").agg(*[F.max(F.when(F.col("tier") > t, F.col("depth"))).alias(f"cut{t}") for t in range(1, tiers)])
    heads = nodes.where("depth > 0").join(cut, "conv", "left")
    last = F.lit(0)
    for t in range(tiers - 1, 0, -1):
        last = F.when(F.col("tier") == t, F.coalesce(F.col(f"cut{t}"), F.lit(0)) + 1).otherwise(last)
    placed = heads.withColumn("head_depth", last.cast("bigint")).drop(*[f"cut{t}" for t in range(1, tiers)])
    path = rows.select("conv", F.col("depth").alias("head_depth"), F.col("hi").alias("head_hi"), F.col("lo").alias("head_lo"))
    placed = placed.join(path, ["conv", "head_depth"]).drop("head_depth")
    root = nodes.where("depth = 0").select(*nodes.columns, F.lit(ROOT[0]).cast("bigint").alias("head_hi"), F.lit(ROOT[1]).cast("bigint").alias("head_lo"))
    return placed.unionByName(root)


# --- node tables

def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (hi.view(np.uint64) + np.uint64(level + 1) * _A) * _B
        y = (lo.view(np.uint64) ^ (np.uint64(level + 1) * _C)) * _A
        x = (x ^ (x >> np.uint64(31))) * _C + y
        x = (x ^ (x >> np.uint64(29))) * _B
        return x ^ (x >> np.uint64(32))


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys: keys that stand alone on a level have that bit's rank as slot."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = np.arange(len(hi)), 0
        while len(left):
            if len(self.levels) == 200:
                raise ValueError("keys of a node table are not distinct")
            spot = self._spot(hi[left], lo[left], len(self.levels), size := int(len(left) * LOAD) + 1)
            alone = np.bincount(spot, minlength=size) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            left = left[~alone[spot]]
        self.hi, self.lo = np.zeros(taken, np.int64), np.zeros(taken, np.int64)
        slots = self._slots(hi, lo)
        self.hi[slots], self.lo[slots] = hi, lo
        if taken != len(hi) or not self._holds(slots, hi, lo).all():
            raise ValueError("a slot of a node table does not hold its key")

    @staticmethod
    def _spot(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(hi, lo, level) % np.uint64(size)).astype(np.int64)

    def _slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, left = np.full(len(hi), -1), np.arange(len(hi))
        for level, (alone, rank) in enumerate(self.levels):
            spot = self._spot(hi[left], lo[left], level, len(alone))
            out[left] = np.where(alone[spot], rank[spot], -1)
            left = left[~alone[spot]]
        return out

    def _holds(self, slots: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return (slots >= 0) & (self.hi[slots] == hi) & (self.lo[slots] == lo)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slots of any keys, -1 for those that are not in the table."""
        if not len(self.hi):
            return np.full(len(hi), -1)
        slots = self._slots(hi, lo)
        return np.where(self._holds(slots, hi, lo), slots, -1)


_IN = ["hi", "lo", "up_hi", "up_lo", "depth", "conv", "n_convs", "words", "more_children", "more_leaves", "more_saved", "head_hi", "head_lo"]
_OUT = ["hi", "lo", "up_hi", "up_lo", "depth", "conv", "n_convs", "parent", "n_children", "n_leaves", "saved_tokens", "is_head"]
RESULT = ", ".join(f"{c} bigint" for c in _OUT[:-1]) + ", is_head boolean"


def node_table(a: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Nodes of whole shards with what their subtrees add up to; a head's parent is in another shard (or none)."""
    table = PerfectHash(a["hi"], a["lo"])
    own, up = table.slots(a["hi"], a["lo"]), table.slots(a["up_hi"], a["up_lo"])
    head = (a["hi"] == a["head_hi"]) & (a["lo"] == a["head_lo"])
    up[head] = -1
    if not (head | (up >= 0)).all():
        raise ValueError("a node's parent is not in its shard")
    n = len(own)
    arrays = {c: np.zeros(n, np.int64) for c in ("depth", "conv", "n_convs", "parent_slot", "children", "leaves", "saved")}
    arrays["depth"][own], arrays["conv"][own], arrays["n_convs"][own], arrays["parent_slot"][own] = a["depth"], a["conv"], a["n_convs"], up
    inside = arrays["parent_slot"] >= 0
    arrays["children"][own] = a["more_children"]
    arrays["children"] += np.bincount(arrays["parent_slot"][inside], minlength=n)
    arrays["leaves"][own] = a["more_leaves"]
    arrays["leaves"] += arrays["children"] == 0
    arrays["saved"][own] = a["more_saved"] + (a["n_convs"] - 1) * a["words"]

    deepest = np.flatnonzero(inside)[np.argsort(-arrays["depth"][inside], kind="stable")]
    bounds = np.flatnonzero(np.diff(arrays["depth"][deepest])) + 1
    for slots in np.split(deepest, bounds):  # one depth at a time
        for name in ("leaves", "saved"):
            np.add.at(arrays[name], arrays["parent_slot"][slots], arrays[name][slots])

    parent = pa.array(np.where(up >= 0, arrays["conv"][up], 0), pa.int64(), mask=up < 0)
    out = [a[c] for c in _OUT[:7]] + [parent, arrays["children"][own], arrays["leaves"][own], arrays["saved"][own], head]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], _OUT)


def accumulated(nodes: DataFrame) -> DataFrame:
    """Results of all nodes of a tier, in tables of whole shards."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def columns(parts: list[np.ndarray]) -> dict[str, np.ndarray]:
            return dict(zip(_IN, np.concatenate(parts, axis=1)))

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _IN])
            held, count = [*held, rows], count + rows.shape[1]
            if count >= BATCH:
                rows = np.concatenate(held, axis=1)
                last = (rows[-2] == rows[-2, -1]) & (rows[-1] == rows[-1, -1])  # the last shard may go on
                if not last.all():
                    yield node_table(columns([rows[:, ~last]]))
                held, count = [rows[:, last]], int(last.sum())
        if count:
            yield node_table(columns(held))

    dealt = nodes.select(*_IN).repartition("head_hi", "head_lo").sortWithinPartitions("head_hi", "head_lo")
    return dealt.mapInArrow(tables, RESULT)


# --- members that end at a node

def ends(rows: DataFrame) -> DataFrame:
    """For each node where conversations end, the SHA-256 of their ids, ascending and comma-joined.

    Ids are put together in ranges of (node, id), by all tasks; the digest then reads a node's pieces in order as a stream.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, text = None, 0, []
        length = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "first": [first], "ids": [",".join(text)]}, schema=_PIECE)

        for batch in batches:
            done = []
            for hi, lo, conv in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key != (hi, lo) or length > CHUNK:
                    if key is not None:
                        done.append(row())
                    key, first, text, length = (hi, lo), conv, [], 0
                text.append(str(conv))
                length += len(text[-1]) + 1
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if key is not None:
            yield row()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def rows_of(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["hi", "lo", "ends_sha256"])

        for batch in batches:
            done = []
            for hi, lo, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key == (hi, lo):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (hi, lo), hashlib.sha256(ids.encode())
            yield rows_of(done)
        if key is not None:
            yield rows_of([(*key, state.hexdigest())])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = rows.where("below = 0").select(*NODE, "conv")
    ranges = last.repartitionByRange(parts, *NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(pieces, "hi bigint, lo bigint, first bigint, ids string")
    grouped = ranges.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return grouped.mapInArrow(hashed, "hi bigint, lo bigint, ends_sha256 string")


_PIECE = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def trie(rebuilt: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the prefix trie of conversations given by :func:`plain_turns` or :func:`shared_turns`.

    Turns are ordered by number (null first; of one number by role, then text). A null role or text counts as empty;
    rows without a conversation id are left out; a turn given twice stands twice. Each distinct sequence of first turns
    (role and text) is a node, the root without turns too; without any conversation there is no node.

    Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, members but one times the words of a node's last text) and
    ends_sha256 (of the ids of the members that end here). ``conv_id`` and ``depth`` name a node.
    """
    rows = materialize(prefixes(rebuilt), "prefixes")
    nodes = materialize(nodes_of(rows), "nodes")
    heaviest = nodes.agg(F.max("weight")).first()[0] or 0
    tiers = 2
    while limit**tiers < heaviest:
        tiers += 1
    nodes = materialize(sharded(rows, nodes.withColumn("tier", tier_of(F.col("weight"), F.col("depth"), limit, tiers)), tiers), "shards")

    added, done = None, []
    more = ["more_children", "more_leaves", "more_saved"]
    for tier in range(1, tiers + 1):
        here = nodes.where(F.col("tier") == tier)
        if added is not None:
            here = here.join(added, NODE, "left")
        zero = F.lit(0).cast("bigint")
        here = here.withColumns({c: F.coalesce(F.col(c), zero) if added is not None else zero for c in more})
        done.append(materialize(accumulated(here), "tier"))
        heads = done[-1].where("is_head").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
        sums = heads.agg(F.count("*").alias(more[0]), F.sum("n_leaves").alias(more[1]), F.sum("saved_tokens").alias(more[2]))
        if added is not None:
            sums = sums.unionByName(added).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in more])
        added = materialize(sums, "added")

    found = done[0]
    for one in done[1:]:
        found = found.unionByName(one)
    # Parents of heads are in a higher tier; the root, parent of most, comes as a single value.
    above = checked_broadcast(nodes.where("tier > 1").select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv").alias("above")))
    found = found.join(above, ["up_hi", "up_lo"], "left").join(ends(rows), NODE, "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "above")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
