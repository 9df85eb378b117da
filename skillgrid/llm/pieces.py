"""SentencePiece encoding and decoding by a prefix table of last tokens, for merge-type (BPE) models.

The encoding of a text's first i characters ends with exactly one token, which the table keeps for i. A token is the right one
if it is compatible with the last token of the prefix before it, that is, both side by side are encoded as themselves. The
automaton over the vocabulary gives the longest token that begins where a prefix ends. The table is filled from the longest
tokens on, and a place that leads nowhere is left for good, so the prefixes that no try reaches cost nothing. The ids are
then read backwards through the table. Time is linear in the text whatever it holds.

No token holds a blank after another character, so a text is the encodings of its words one after another; a worker
remembers the ids of words it has met, in a bounded cache. Characters outside the vocabulary become their bytes.
"""

from __future__ import annotations

import codecs
import math
import re
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import accumulate, chain, groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROWS, arrow_column, utf8

BLANK = "▁"  # stands for a space
LONGEST = 64  # characters of a word in the cache
CACHE = 1 << 18  # words in either half of a worker's cache, and pairs whose compatibility it remembers
KINDS = 4  # sets of characters between which words are cut
UNKNOWN = " ⁇ "  # what the library writes for the unknown id

# The library writes one replacement character for each byte that begins no valid character.
codecs.register_error("one-byte", lambda error: ("�", error.start + 1))


class Words(dict):
    """Ids of the words met. When full it becomes the older half of the cache, from which words in use come back."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.older.get(word)
        if found is None:
            found = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


class Vocabulary:
    """Pieces of a merge-type model: scores, automaton, pairs and byte ids."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        size = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:-1], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.unknown = model.unk_id()
        if model.normalize("a  b\tc ") != BLANK + "a  b\tc ".replace(" ", BLANK):
            raise ValueError("only models that keep texts and put a blank before them are supported")
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece holds a blank after another character")

        # A byte stands for itself if it is a character of its own, else for the surrogate that Python escapes it with.
        self.text = [p.replace(BLANK, " ") if not special[i] else "" for i, p in enumerate(self.pieces)]
        self.text[self.unknown] = UNKNOWN
        for byte, i in self.bytes.items():
            self.text[i] = bytes([byte]).decode("utf-8", "surrogateescape")
        self.silent = {i for i in range(size) if model.is_control(i)}

        self.known = {c for p in self.ids for c in p}
        self.pairs: dict[tuple[str, str], bool] = {}
        letters = "".join(re.escape(c) for c in sorted(self.known - {BLANK}))
        runs = "|".join(f"[{''.join(map(re.escape, sorted(kind)))}]+" for kind in self.kinds())
        self.words = re.compile(f"{BLANK}*(?:{runs})|{BLANK}+|[^{letters}{BLANK}]").findall
        self.cache = Words(self.word)

    def kinds(self) -> list[set[str]]:
        """Characters in sets of which no piece holds two, such as letters and signs; so no merge joins them.

        The largest sets are returned, and the union of the others.
        """
        kind = {c: {c} for c in self.known - {BLANK}}
        for piece in self.ids:
            for a, b in pairwise(piece.lstrip(BLANK)):
                if kind[a] is not kind[b]:
                    small, large = sorted((kind[a], kind[b]), key=len)
                    large |= small
                    kind.update(dict.fromkeys(small, large))
        sets = sorted({id(s): s for s in kind.values()}.values(), key=lambda s: (-len(s), min(s)))
        return [s for s in (*sets[:KINDS], set().union(*sets[KINDS:])) if s]

    @cached_property
    def automaton(self):
        """Finds the tokens that end at each character of a text, longest first."""
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for piece in [*self.halves, *self.known]:
            automaton.add_word(piece, piece)
        automaton.make_automaton()
        return automaton

    @cached_property
    def longest(self) -> dict[str, str]:
        """The longest token that begins each string that begins a token."""
        tokens, out = {*self.halves, *self.known}, {}
        for start in sorted({p[:n] for p in tokens for n in range(1, len(p) + 1)}, key=len):
            out[start] = start if start in tokens else out[start[:-1]]
        return out

    @cached_property
    def shorter(self) -> dict[str, str | None]:
        """The longest token that begins a longer one; a character has none."""
        return {token: self.longest.get(token[:-1]) for token in set(self.longest.values())}

    @cached_property
    def ids_of(self) -> dict[str, tuple[int, ...]]:
        return {token: (self.ids[token],) if token in self.ids else self.bytes_of(token) for token in self.shorter}

    @cached_property
    def width(self) -> int:
        return max(map(len, self.longest))

    @cached_property
    def halves(self) -> dict[str, tuple[str, str]]:
        """The pieces of several characters that stand in encodings, that is, those encoded as themselves, and what they are
        merged from."""
        return {p: tuple(self.merged(p, 2)) for p in self.ids if len(p) > 1 and self.merged(p) == [p]}

    @cached_property
    def late(self) -> set[str]:
        """Pieces merged from one with no better score, or that hold such a piece."""
        out: set[str] = set()
        for p in sorted(self.halves, key=len):
            if any(half in out or half in self.halves and self.score[half] <= self.score[p] for half in self.halves[p]):
                out.add(p)
        return out

    def merged(self, text: str, down_to: int = 1) -> list[str]:
        """Encoding of a short text by its definition: merge the best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while len(parts) > down_to:
            best = max(((self.score[p], -k) for k, p in enumerate(map(str.__add__, parts, parts[1:])) if p in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens side by side are encoded as themselves."""
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            plain = left in self.late or right in self.late
            found = self.pairs[pair] = self.merged(left + right) == [left, right] if plain else self._apart(left, right)
        return found

    def _apart(self, x: str, y: str) -> bool:
        """Whether no merge joins what stands on either side of the seam of two tokens at any time.

        Seen backwards in time: the side merged last is taken apart first, which leaves its half at the seam. As halves have
        better scores than what they form, merges of either side happen in the order of their scores, the left one of
        equals first. A merge across the seam happens if it is due before both halves are merged away.
        """
        never = -math.inf
        gone_x = gone_y = never  # scores of the merges that take x and y away
        while True:
            across = self.score.get(x + y)
            if across is not None and across > gone_x and across >= gone_y:
                return False
            made_x = self.score[x] if len(x) > 1 else math.inf
            made_y = self.score[y] if len(y) > 1 else math.inf
            if made_x < made_y:
                x, gone_x = self.halves[x][1], made_x
            elif made_y < math.inf:
                y, gone_y = self.halves[y][0], made_y
            else:
                return True

    def last_tokens(self, text: str) -> list[str]:
        """For each prefix of a text of known characters, the last token of its encoding."""
        last: list[str | None] = [None] * (len(text) + 1)
        seen = self.pairs.get
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                before = last[end - len(token)]
                if before is None:  # the text begins here
                    last[end] = token
                else:
                    fits = seen((before, token))
                    if fits or fits is None and self.compatible(before, token):
                        last[end] = token
        return last

    def reached_tokens(self, text: str) -> list[str | None]:
        """The table of :meth:`last_tokens` up to a text's end, without the prefixes that no try of longest tokens reaches."""
        size, width = len(text), self.width
        last: list[str | None] = [None] * (size + 1)
        seen, longest, shorter, begun = self.pairs.get, self.longest, self.shorter, self.automaton.longest_prefix
        at, before, token = 0, None, longest[text[: begun(text[:width])]]
        while True:
            while token is not None:
                end = at + len(token)
                if last[end] is None:  # else tried before, without success
                    fits = before is None or seen((before, token))
                    if fits or fits is None and self.compatible(before, token):
                        break
                token = shorter[token]
            if token is None:  # no token goes on from here, so the last one gives way to a shorter one
                at -= len(before)
                token, before = shorter[before], last[at]
                continue
            last[end] = before = token
            if end == size:
                return last
            at = end
            token = longest[text[at : at + begun(text[at : at + width])]]

    def bytes_of(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes.get(b, self.unknown) for b in c.encode()) if self.bytes else (self.unknown,)

    def word(self, word: str) -> tuple[int, ...]:
        if word[0] not in self.known:
            return self.bytes_of(word)
        last, end, tokens = self.reached_tokens(word), len(word), []
        while end:
            token = last[end]
            tokens.append(token)
            end -= len(token)
        return tuple(chain.from_iterable(map(self.ids_of.__getitem__, reversed(tokens))))

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        words = self.words(BLANK + text.replace(" ", BLANK))
        return np.fromiter(chain.from_iterable(map(self.cache.__getitem__, words)), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes side by side form characters, and the blank put before the text goes."""
        if self.silent.isdisjoint(ids):
            return self._joined(ids)
        runs = [list(run) for silent, run in groupby(ids, self.silent.__contains__) if not silent]
        return "".join(self._joined(run, k == 0) for k, run in enumerate(runs))

    def _joined(self, ids: list[int], start: bool = True) -> str:
        text = "".join(map(self.text.__getitem__, ids))
        if start and ids and self.pieces[ids[0]][0] == BLANK:
            text = text[1:]
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "one-byte")
        return text


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(model_path: str) -> Vocabulary:
    """The vocabulary of a model, made once in a worker."""
    if model_path not in _vocabularies:
        _vocabularies[model_path] = Vocabulary(model_path)
    return _vocabularies[model_path]


def encode(text: Column, model_path: str) -> Column:
    """Ids of a text given as UTF-8 bytes, without begin or end ids; null is an empty text."""

    def ids(values: list, vocab: Vocabulary) -> list[np.ndarray]:
        return [vocab.encode(raw.decode("utf-8", "one-byte") if raw else "") for raw in values]

    return arrow_column(ids, "array<int>", pa.list_(pa.int32()), lambda: vocabulary(model_path))(text)


def decode(ids: Column, model_path: str) -> Column:
    """Text of ids; null ids give an empty text."""

    from pyspark.sql.functions import arrow_udf

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(model_path)
        for batch in batches:
            parts = [pa.array([], pa.string())]
            for start in range(0, len(batch), ROWS):  # few texts at a time as Python objects
                rows = batch.slice(start, ROWS)
                flat, n = rows.flatten().to_numpy(zero_copy_only=False).tolist(), rows.value_lengths().fill_null(0).to_pylist()
                ends = [0, *accumulate(n)]
                parts.append(pa.array([vocab.decode(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string()))
            yield pa.concat_arrays(parts)

    texts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(texts, "string")(ids)


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text: doc_id, ids (array of int).

    Every row gives one row, rows that repeat an id too. A null or empty text has no ids; an empty table gives none.
    Strings that look like special or byte tokens are ordinary text. Other columns are not read.
    """
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), encode(utf8(text_col), model_path).alias("ids"))


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """The rows of :func:`encoded` with the ``text`` that their ids give."""
    return rows.select("doc_id", "ids", decode(F.col("ids"), model_path).alias("text"))
