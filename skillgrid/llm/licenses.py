"""Licence scans by template markup compiled to token automata.

A template is licence wording with ``<<beginOptional>> ... <<endOptional>>`` for parts that may be missing
and ``<<var;words=a-b>>`` for parts that may be replaced by a to b words of any kind. It is compiled to an
automaton over words; a text has the template where the automaton accepts, that is where all mandatory
words stand exactly. Texts without a template's longest mandatory run never reach the automaton.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, utf8, words_of

# Phrases whose labels every scan must give.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Public standard wordings, in words, with markup.
TEMPLATES = {
    "agpl": ["affero general public license"],
    "apache-2.0": ["apache license <<beginOptional>>version<<endOptional>> 2 0"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "<<beginOptional>>under<<endOptional>> the bsd <<var;words=0-2>> license",
    ],
    "cc-by-nc": ["cc by nc <<beginOptional>>sa<<endOptional>> <<beginOptional>><<var;words=1-1>> 0<<endOptional>>"],
    "cc-by-sa": ["cc by sa <<beginOptional>><<var;words=1-1>> 0<<endOptional>>"],
    "cc0": ["cc0 <<beginOptional>>1 0<<endOptional>> <<beginOptional>>universal<<endOptional>>"],
    "copyright": ["copyright <<beginOptional>>c<<endOptional>> <<var;words=1-8>> all rights reserved"],
    "gpl-2.0": ["gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 2"],
    "gpl-3.0": ["gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 3"],
    "lgpl": ["lesser general public license"],
    "mit": [
        "<<beginOptional>>released under<<endOptional>> the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction",
    ],
    "mpl-2.0": ["mozilla public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> 2 0"],
    "public-domain": ["released into the public domain"],
}

MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>|([^\s<]+)")


@dataclass
class Automaton:
    """Words automaton: ``words`` and ``any_word`` are edges that read a word, ``free`` edges read none."""

    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any_word: list[int | None] = field(default_factory=lambda: [None])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    accept: int = 0
    anchor: bytes = b""  # longest run of words that every accepted text has

    def state(self) -> int:
        self.words.append({})
        self.any_word.append(None)
        self.free.append([])
        return len(self.words) - 1

    def closure(self, state: int) -> list[int]:
        seen, todo = [], [state]
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.append(s)
                todo.extend(self.free[s])
        return seen

    def places(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(start, end) of every end of a match, with its latest start."""
        out, active = [], {}
        start_states = self.closure(0)
        for i, word in enumerate(words):
            for s in start_states:
                active[s] = i
            after: dict[int, int] = {}
            for s, began in active.items():
                for target in (self.words[s].get(word), self.any_word[s]):
                    if target is not None:
                        for t in self.closure(target):
                            after[t] = max(began, after.get(t, -1))
            active = after
            if self.accept in active:
                out.append((active[self.accept], i + 1))
        return out


def compile_template(markup: str) -> Automaton:
    out, at, open_parts, runs = Automaton(), 0, [], [[]]
    for m in MARK.finditer(markup):
        kind, low, high, plain = m.groups()
        if plain:
            for word in words_of(plain.encode()):
                after = out.state()
                out.words[at][word] = after
                at = after
                if not open_parts:
                    runs[-1].append(word)
            continue
        runs.append([])
        if kind == "beginOptional":
            inside = out.state()  # a state of its own, so that a repeated word cannot leave the part
            out.free[at].append(inside)
            open_parts.append(at)
            at = inside
        elif kind == "endOptional":
            if not open_parts:
                raise ValueError(f"endOptional without begin: {markup}")
            after = out.state()
            out.free[at].append(after)
            out.free[open_parts.pop()].append(after)
            at = after
        else:
            if int(low) > int(high):
                raise ValueError(f"words={low}-{high}: {markup}")
            ends = [at]
            for _ in range(int(high)):
                after = out.state()
                out.any_word[at] = after
                at = after
                ends.append(at)
            after = out.state()
            for s in ends[int(low) :]:
                out.free[s].append(after)
            at = after
    if open_parts or not any(runs):
        raise ValueError(f"an open optional part, or no mandatory word: {markup}")
    out.accept = at
    out.anchor = b" " + b" ".join(max(runs, key=len)) + b" "
    return out


@dataclass
class Scanner:
    base: list[tuple[str, bytes]]
    templates: list[tuple[str, Automaton]]

    def scan(self, text: bytes | None) -> dict:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        starts, base_labels, spans = [], set(), []
        for label, phrase in self.base:
            place, last, at = 0, 0, joined.find(phrase)
            while at >= 0:
                place += joined.count(b" ", last, at)  # blanks since the last place
                last = at
                starts.append(place)
                base_labels.add(label)
                spans.append((label, place, place + phrase.count(b" ") - 1))
                at = joined.find(phrase, at + 1)
        for label, automaton in self.templates:
            if automaton.anchor in joined:
                spans.extend((label, a, b) for a, b in automaton.places(words))
        labels = sorted({label for label, _, _ in spans})
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(labels),
            "score": len(labels) / (len(labels) + 1),
            "spans": [{"label": label, "start": a, "stop": b} for label, a, b in sorted(spans, key=lambda s: (s[1], s[2], s[0]))],
        }


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
_RESULT = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
])
RESULT = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,"
    "score:double,spans:array<struct<label:string,start:bigint,stop:bigint>>>"
)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE,
    templates: dict[str, list[str]] = TEMPLATES,
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base phrases count at every place, overlapping ones too; ``spans`` lists every accepted place in words.
    ``score`` is k / (k + 1) for k labels. Null text counts as empty;
    repeated rows are kept; an empty table gives an empty result.
    """

    def setup() -> Scanner:
        phrases = [(label, b" " + b" ".join(words_of(p.encode())) + b" ") for label, p in base.items()]
        return Scanner(phrases, [(label, compile_template(t)) for label, texts in templates.items() for t in texts])

    setup()  # a faulty template fails here, not in a task
    scan = arrow_column(lambda texts, scanner: [scanner.scan(t) for t in texts], RESULT, _RESULT, setup)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), scan(utf8(text_col)).alias("_r")).select("doc_id", "_r.*")
