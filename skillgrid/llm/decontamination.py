"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words (a bounded block of them at a time) become one automaton on the driver, which is
broadcast. Documents stream through it in one map-only pass: at each word the automaton knows the longest
run ending there that occurs in some item. Runs that reach the limits (``window`` words, or the whole
of a shorter item) are hits; overlapping hits merge to spans, which can be cut out of the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, free_name, materialize, utf8, words_of

BLOCK_WORDS = 100_000  # words of items in one automaton: the broadcast's bound
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


@dataclass
class Automaton:
    """Suffix automaton over several sequences: states, their suffix links and longest lengths."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    edges: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    owners: dict[int, list[str]] = field(default_factory=dict)  # state of a window -> items with it
    whole: dict[int, list[tuple[int, str | None]]] = field(default_factory=dict)  # state -> short items ending there
    shortest: int = 0  # words of the shortest possible hit

    def extend(self, last: int, word: int) -> int:
        if (known := self.edges[last].get(word)) is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._new({}, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.edges[at]:
            self.edges[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            target = self.edges[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return state

    def _new(self, edges: dict[int, int], length: int, link: int = 0) -> int:
        self.edges.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.edges) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        copy = self._new(dict(self.edges[target]), self.length[at] + 1, self.link[target])
        self.link[target] = copy
        while at >= 0 and self.edges[at].get(word) == target:
            self.edges[at][word] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run after one more word."""
        while state and word not in self.edges[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.edges[state]:
            return self.edges[state][word], length + 1
        return 0, 0

    def holder(self, state: int, size: int) -> int:
        """The state on the suffix path that stands for the last ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


def build(items: list[tuple[str | None, list[bytes]]], window: int) -> Automaton:
    out = Automaton(window)
    sequences = []
    for item, words in items:
        ids = [out.vocabulary.setdefault(w, len(out.vocabulary)) for w in words]
        if ids:
            sequences.append((item, ids))
            last = 0
            for w in ids:
                last = out.extend(last, w)
    for item, ids in sequences:  # the automaton is final only now
        state = length = 0
        for i, w in enumerate(ids):
            state, length = out.step(state, length, w)
            if i + 1 >= window:
                names = out.owners.setdefault(out.holder(state, window), [])
                if item is not None and item not in names:
                    names.append(item)
        if len(ids) < window:
            entry = (len(ids), item)
            ends = out.whole.setdefault(out.holder(state, len(ids)), [])
            if entry not in ends:
                ends.append(entry)
    out.shortest = min((min(len(ids), window) for _, ids in sequences), default=0)
    return out


def runs_of(automaton: Automaton, words: list[bytes]):
    """Stretches of words that all occur in items and are long enough to hold a hit."""
    ids = np.fromiter(map(automaton.vocabulary.get, words, repeat(-1)), np.int64, len(words))
    unknown = np.concatenate(([-1], np.flatnonzero(ids < 0), [len(ids)]))
    for k in np.flatnonzero(np.diff(unknown) > automaton.shortest):
        yield int(unknown[k]) + 1, ids[unknown[k] + 1 : unknown[k + 1]].tolist()


def scan(automaton: Automaton, words: list[bytes]) -> tuple[list[list[int]], set[str], int]:
    """Merged hit spans [start, end) in words, items with an occurring window, longest run met."""
    spans: list[list[int]] = []
    items: set[str] = set()
    longest = 0
    if not automaton.shortest:
        return spans, items, longest

    def hit(start: int, end: int) -> None:
        while spans and spans[-1][1] >= start:  # touching or overlapping
            start = min(start, spans.pop()[0])
        spans.append([start, end])

    for first, ids in runs_of(automaton, words):
        state = length = 0
        for i, w in enumerate(ids, first):
            state, length = automaton.step(state, length, w)
            longest = max(longest, length)
            if length >= automaton.window:
                items.update(automaton.owners[automaton.holder(state, automaton.window)])
                hit(i + 1 - automaton.window, i + 1)
            if automaton.whole:
                at = state
                while at > 0:
                    for size, item in automaton.whole.get(at, ()):
                        if size <= length:
                            hit(i + 1 - size, i + 1)
                            if item is not None:
                                items.add(item)
                    at = automaton.link[at]
    return spans, items, longest


RESULT = "struct<n_words:bigint,longest:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<string>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_RESULT = pa.struct([("n_words", pa.int64()), ("longest", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """Blocks of (id as text, words), each of about ``block_words`` words, one in the driver at a time."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), utf8(text_col).alias("t")).where(F.col("t").isNotNull())
    size = rows.select(F.sum(F.octet_length("t")).alias("n")).first().n or 0
    blocks = max(1, -(-size // (6 * block_words)))  # about six bytes to a word
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield b, blocks, [(r.id, words_of(bytes(r.t))) for r in part.toLocalIterator()]


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    result: str = "_match",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with one more column, a struct of n_words, longest, spans (in words) and items.

    A hit is a run of ``window`` words of one item, or the whole of a shorter item that has words. Null
    texts have no words, on both sides; repeated rows are kept; an item without an id still hits but is not
    listed. Without items there are no hits.
    """
    sc = docs.sparkSession.sparkContext
    kept = [c for c in docs.columns if c.lower() != result.lower()]
    out = docs
    for b, blocks, block in item_blocks(items, item_id_col, item_text_col, block_words):
        shared = sc.broadcast(build(block, window))

        def find(texts: list, automaton: Automaton) -> list[dict]:
            rows = []
            for text in texts:
                words = words_of(text)
                spans, names, longest = scan(automaton, words)
                rows.append({
                    "n_words": len(words), "longest": longest,
                    "spans": [{"start": s, "stop": e} for s, e in spans], "items": sorted(names),
                })
            return rows

        column = arrow_column(find, RESULT, _RESULT, lambda shared=shared: shared.value)(utf8(text_col))
        if b == 0:
            out = out.withColumn(result, column)
        else:
            more = out.withColumn(f"{result}_more", column)
            union = merge_spans(F.concat(f"{result}.spans", f"{result}_more.spans"))
            both = F.struct(
                F.col(f"{result}.n_words").alias("n_words"),
                F.greatest(f"{result}.longest", f"{result}_more.longest").alias("longest"),
                union.alias("spans"),
                F.array_sort(F.array_union(f"{result}.items", f"{result}_more.items")).alias("items"),
            )
            out = more.select(*[F.col(f"`{c}`") for c in kept], both.alias(result))
        if blocks > 1:
            out = materialize(out, "matches")  # one block's automaton in a worker at a time
    return out


def merge_spans(spans):
    """Sorted union of spans of one document."""
    start = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def add(merged, s):
        last = F.element_at(merged, -1)
        joined = F.concat(
            F.slice(merged, 1, F.size(merged) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))),
        )
        return F.when((F.size(merged) > 0) & (F.try_element_at(merged, F.lit(-1))["stop"] >= s["start"]), joined).otherwise(F.concat(merged, F.array(s)))

    return F.aggregate(F.array_sort(spans), start, add)


def n_hit(result: str = "_match"):
    return F.aggregate(f"{result}.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans, and what stands between them."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at : places[start][0]])
        at = places[stop - 1][1]
    return b"".join([*out, text[at:]])


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """id, n_words, n_hit, longest, spans and items of every document."""
    found = matches(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{options.get('text_col', 'text')}`").alias("text")), items, **{**options, "text_col": "text"})
    return found.select("doc_id", "_match.n_words", n_hit().alias("n_hit"), "_match.longest", "_match.spans", "_match.items")


def decontaminated(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with hit spans cut out of the text; documents hit in over ``max_coverage`` of their words go.

    Documents without a hit stay as they are. Columns and their order stay.
    """

    def cut(rows: list) -> list:
        return [r and cut_spans(r["t"], [(s["start"], s["stop"]) for s in r["spans"]]).decode() for r in rows]

    # Written before the second Python step, so that no task holds two Python workers at a time.
    match = free_name(docs, "_match")
    found = materialize(matches(docs, items, text_col=text_col, result=match, **options), "matches")
    found = found.where(n_hit(match) <= max_coverage * F.col(f"{match}.n_words"))
    hit = F.size(f"{match}.spans") > 0
    # Only texts with a hit go through Python again.
    pair = F.when(hit, F.struct(utf8(text_col).alias("t"), F.col(f"{match}.spans").alias("spans")))
    column = F.when(hit, arrow_column(cut, "string", pa.string())(pair)).otherwise(F.col(f"`{text_col}`"))
    return found.select(*[column.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])

