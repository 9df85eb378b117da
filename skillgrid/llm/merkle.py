"""Merkle manifest of a table: sibling-shift self-joins from the leaves up, paths joined back down.

Each row is a leaf, rows of a group form a tree in a given order, and the groups' roots form one tree more.
Places in a tree come from a range partitioning (number within a partition plus the partition's offset), so that
no group is sorted in one task. Every level is one equijoin of nodes with the computed indices of their siblings:
``idx XOR 1`` in a binary tree, otherwise the first index of the run plus the slot shifted by 1, 2, ... Both sides
are laid out by parent, so a node is shuffled once a side and its siblings meet it without a further exchange.
Nodes in slot zero then emit the parents. Digests travel as 32 bytes and are hashed as lowercase hex.

The levels are written to the shared folder: the number of jobs grows with the logarithm of the largest group.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ARITY = 8
NULL_GROUP = "-"  # sorts before every name, which begins with "="
PATH = "array<struct<before: binary, after: binary>>"

# Lets an equijoin on (tree, parent, sibling) use a layout by (tree, parent): a run holds at most ARITY nodes.
_LAYOUT = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _layout_by_parent(spark):
    before = spark.conf.get(_LAYOUT, None)
    spark.conf.set(_LAYOUT, "false")
    try:
        yield
    finally:
        spark.conf.unset(_LAYOUT) if before is None else spark.conf.set(_LAYOUT, before)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its length in UTF-8 bytes, ``:``, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest_of(F.concat(*[field(v) for v in values]))


def placed(frame: DataFrame, tree: str, *order: str) -> DataFrame:
    """``idx``, a row's place in its tree from 0 on, and ``size``, the tree's number of rows, added to a written table."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    dealt = materialize(dealt.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)), "placed")
    # One row for each tree in a partition: no more than partitions and trees together.
    runs = dealt.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tree, "_part", "_first", F.sum("_n").over(whole).alias("size"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return dealt.join(runs, [tree, "_part"]).withColumn("idx", F.col("_row") - F.col("_first") + F.col("_before")).drop("_row", "_part", "_first", "_before")


def _siblings(idx: Column, size: Column, arity: int) -> Column:
    """Indices of the other nodes of a node's run."""
    if arity == 2:
        others = F.array(idx.bitwiseXOR(F.lit(1)))
    else:
        slot = idx % arity
        others = F.transform(F.array(*[F.lit(s) for s in range(1, arity)]), lambda shift: idx - slot + (slot + shift) % arity)
    return F.filter(others, lambda i: i < size)


def linked(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, idx, size, digest, others) with ``parent`` and what stands ``before`` and ``after`` them in their run."""
    columns = [*nodes.columns, "parent"]
    laid = nodes.withColumn("parent", F.expr(f"idx div {arity}")).repartition("tree", "parent")
    seeking = laid.select(*columns, F.explode_outer(_siblings(F.col("idx"), F.col("size"), arity)).alias("sibling"))
    there = laid.select("tree", "parent", F.col("idx").alias("sibling"), F.col("digest").alias("other"))
    met = seeking.join(there, ["tree", "parent", "sibling"], "left")
    run = met.groupBy(*columns).agg(F.collect_list(F.when(F.col("other").isNotNull(), F.struct("sibling", "other"))).alias("run"))
    side = lambda rule: F.aggregate(F.filter(F.array_sort("run"), rule), F.lit(b""), lambda all_, s: F.concat(all_, s.other))
    return run.select(*columns, side(lambda s: s.sibling < F.col("idx")).alias("before"), side(lambda s: s.sibling > F.col("idx")).alias("after"))


def parents(links: DataFrame, arity: int) -> DataFrame:
    """The parents of linked nodes, emitted by the nodes in slot zero."""
    return links.where(F.col("idx") % arity == 0).select(
        "tree",
        F.col("parent").alias("idx"),
        F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
        digest_of(F.concat(hexed(F.col("digest")), hexed(F.col("after")))).alias("digest"),
    )


def grown(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of links, from the nodes up, and the roots (tree, digest, level)."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels, roots = [], []
    while True:
        roots.append(nodes.where("size = 1").select("tree", "digest", F.lit(len(levels)).alias("level")))
        if largest <= 1:
            break
        with _layout_by_parent(nodes.sparkSession):
            levels.append(materialize(linked(nodes.where("size > 1"), arity), "level"))
        nodes, largest = parents(levels[-1], arity), -(-largest // arity)
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return levels, out


def descended(levels: list[DataFrame], leaves: DataFrame, seeds: DataFrame, carried: list[str]) -> DataFrame:
    """Leaves with their ``path``: what stands before and after on every level, from the leaf's own up.

    ``seeds``: for each tree the level of its root, the path above it, and the columns ``carried`` down.
    """
    paths = None
    for k in range(len(levels), -1, -1):
        nodes = levels[k] if k < len(levels) else None
        here = seeds.where(F.col("level") == k)
        if k == 0:  # trees of one leaf are leaves and roots at once
            alone = leaves.where("size = 1").join(here.drop("level"), "tree").withColumnRenamed("above", "path")
        else:
            alone = here.select("tree", F.lit(0).cast("bigint").alias("idx"), F.col("above").alias("path"), *carried)
        if nodes is None:
            paths = alone
            continue
        up = paths.select("tree", F.col("idx").alias("parent"), F.col("path").alias("above"), *carried)
        step = F.array(F.struct("before", "after"))
        keep = [c for c in (leaves.columns if k == 0 else ["tree", "idx"]) if c not in ("before", "after")]
        below = nodes.join(up, ["tree", "parent"]).select(*keep, F.concat(step, "above").alias("path"), *carried)
        paths = below.unionByName(alone.select(*below.columns))
    return paths


def folded(start: Column, path: Column) -> Column:
    """The root in hex that a leaf (in hex) and its path give."""
    return F.aggregate(path, start, lambda digest, s: F.sha2(F.concat(hexed(s.before), digest, hexed(s.after)), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings of a path, level by level, left to right."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda all_, s: F.concat(all_, hexed(s.before), hexed(s.after))), 256)


def manifest(
    rows: DataFrame,
    id_col: str = "doc_id",
    leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    arity: int = ARITY,
    variants: dict[str, dict[str, Column]] | None = None,
) -> DataFrame:
    """Every row's leaf, its group's root (``subroot``), the ``root`` of all, and the ``path`` that proves it.

    A leaf is the digest of the fields (:func:`field`) of ``leaf_cols``. Within a group leaves ascend by id (a null id
    first; rows of one id by their leaf digest), then every ``arity`` consecutive nodes become one until one is left;
    roots of the groups, ordered by name (null first, by bytes), likewise. ``variants`` gives further leaf digests of a
    row, as {name: {column: changed value}}; they are carried along and belong to no tree.

    Returns id, leaf, subroot, root (hex), path (array of before and after, as bytes) and the variants in hex. Rows that
    repeat another are leaves of their own. An empty table gives no rows; a null or empty text is a value like any other;
    other columns are not read.
    """
    given = {c: F.col(f"`{c}`") for c in leaf_cols}
    variants = variants or {}
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(NULL_GROUP))
    changed = [leaf_digest(*(given | change).values()).alias(name) for name, change in variants.items()]
    leaves = rows.select(F.col(f"`{id_col}`").alias("id"), group.alias("tree"), leaf_digest(*given.values()).alias("digest"), *changed)
    leaves = materialize(placed(materialize(leaves, "leaves"), "tree", "id", "digest"), "leaves")
    levels, subroots = grown(leaves, arity)

    tops = materialize(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest", "level"), "subroots")
    tops = materialize(placed(tops, "tree", "group"), "tops")
    top_levels, top_roots = grown(tops.select("tree", "idx", "size", "digest"), arity)
    seeds = top_roots.select("tree", "level", F.array().cast(PATH).alias("above"), F.col("digest").alias("root"))
    # Leaves of the upper tree are the lower trees' roots.
    upper = descended(top_levels, tops.select("tree", "idx", "size"), seeds, ["root"])
    upper = upper.join(tops.drop("size"), ["tree", "idx"]).select(
        F.col("group").alias("tree"), "level", F.col("path").alias("above"), "root", F.col("digest").alias("subroot")
    )
    found = descended(levels, leaves, materialize(upper, "upper"), ["root", "subroot"])
    return found.select(
        F.col("id").alias(id_col),
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        "path",
        *[hexed(F.col(name)).alias(name) for name in variants],
    )
