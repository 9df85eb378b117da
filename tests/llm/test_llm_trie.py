"""Prefix trie of conversations against a plain one, and its node tables."""

import hashlib
import math
import random
import zlib

import fixtures_llm as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from skillgrid.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def conversations(spark, rows):
    return fx.table(spark, rows, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "pos", "depth", "hi", "words", "tier")})


def plain_trie(rows, shared=True):
    own, out, members, below = {}, [], {}, {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    own = {c: [turn[1:] for turn in sorted(turns)] for c, turns in own.items()}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4 if shared else 0
        whole = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:] if shared else own[c]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    for node in sorted(members, key=len, reverse=True):
        children = [x for x in members if len(x) == len(node) + 1 and x[:-1] == node] if len(members) < 3000 else below.get((node, "kids"), [])
        leaves = sum(below[x][0] for x in children) if children else 1
        saved = (len(members[node]) - 1) * (len(node[-1][1].split()) if node else 0) + sum(below[x][1] for x in children)
        below[node] = (leaves, saved, len(children))
    for node, found in members.items():
        ended = ",".join(str(c) for c, last in sorted(found) if last)
        parent = min(members[node[:-1]])[0] if node else None
        leaves, saved, children = below[node]
        out.append((min(found)[0], len(node), parent, len(found), children, leaves, saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def hard_conversations():
    """Few texts, so that prefixes meet: nulls, ties, repeated rows, null ids, negative ids, a group of copies, one long one."""
    rng = random.Random(8)
    rows = []
    for c in [*range(-45, 0), *range(70)]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([turn] * 8 + [None, 0]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "a b", "ñ  \t c d"])))
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(3)]
    rows += [(300, t, "user", "again and again") for t in range(70)] + rows[:5] + [(None, 1, "user", "x")] * 3
    return rows


@pytest.mark.parametrize("limit", [2, 5, 40, trie.LIMIT])
def test_shared_conversations_are_the_plain_trie(spark, limit):
    rows = hard_conversations()
    assert got(trie.trie(trie.shared_turns(conversations(spark, rows), 20, 3), limit)) == plain_trie(rows)


def test_plain_conversations_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST", 2)
    rows = hard_conversations()
    assert got(trie.trie(trie.plain_turns(conversations(spark, rows)), 7)) == plain_trie(rows, shared=False)


def test_no_conversations_and_one_without_turns(spark):
    assert trie.trie(trie.shared_turns(conversations(spark, []), 20, 3)).count() == 0
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(c, 0, "user", "its only turn is replaced")]
    assert got(trie.trie(trie.shared_turns(conversations(spark, rows), 20, 3))) == plain_trie(rows)


def test_ids_of_many_members_are_hashed_in_order(spark, monkeypatch):
    rows = [(c, 0, "user", "hi") for c in range(-500, 500)]
    text = ",".join(map(str, range(-500, 500)))
    node = trie.trie(trie.plain_turns(conversations(spark, rows))).where("depth = 1").first()
    assert node.ends_sha256 == hashlib.sha256(text.encode()).hexdigest() and node.n_convs == 1000 and node.saved_tokens == 999


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 20_000):
        hi, lo = rng.integers(-(1 << 62), 1 << 62, n), rng.integers(0, 5, n)  # many equal halves
        table = trie.PerfectHash(hi, lo)
        assert sorted(table.slots(hi, lo)) == list(range(n))
        assert (table.slots(hi + 1, lo) == -1).all()
    with pytest.raises(ValueError):
        trie.PerfectHash(np.array([1, 1]), np.array([2, 2]))


def test_shards_are_bounded(spark):
    rows = [(c, t, "user", f"{t} {c // 4 ** (6 - t)}") for c in range(1000) for t in range(6)]
    prefixes = trie.prefixes(trie.plain_turns(conversations(spark, rows)))
    nodes = trie.nodes_of(prefixes)
    tiers = nodes.withColumn("tier", trie.tier_of(F.col("weight"), F.col("depth"), 10, 4))
    sizes = trie.sharded(prefixes, tiers, 4).groupBy("tier", "head_hi", "head_lo").count()
    assert sizes.where("tier = 1").agg(F.max("count")).first()[0] <= 10 + 1
    assert sizes.agg(F.max("count")).first()[0] <= 10 * 6
