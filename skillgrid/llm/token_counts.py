"""Token counts: a broadcast table of frequent pre-token lengths, worker caches for the rest.

Two passes over whole texts. The first finds frequent pre-tokens: each task counts its own in a
bounded summary (space-saving by pruning), and the summaries, one row per task with the pre-tokens that
reach a fixed share of its own, are merged in two small steps. The second splits each text into pre-tokens
and adds their lengths: first from the broadcast table, then from a bounded cache in the worker that
encodes a miss with the tokenizer's model. Pre-tokens of texts are never shuffled, only those summaries;
their quality affects speed alone: counts are always exact.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, slices, utf8

ENTRIES = 1 << 15  # frequent pre-tokens kept: the broadcast's bound
LONGEST = 64  # characters of a pre-token in the table or a cache
CACHE = 1 << 18  # pre-tokens a worker remembers
CHUNK = 1 << 20  # characters of text split at a time

# The published split pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters on which all Unicode versions agree about letters, numbers and spaces; parts of texts with any
# other character are split by the tokenizer's own pre-tokenizer, which is slower.
UNSAFE = regex.compile(r"[^\t\n\r\x20-\x7E\xA1-ɏА-яぁ-ゖァ-ヺ一-龥가-힣]")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for 256 and up, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class PreTokens:
    """Splits texts into pre-tokens as the tokenizer does."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model, self.pre_tokenizer = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.plain_split = regex.compile(PATTERN).findall
        self.letters = byte_letters()
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("special tokens that depend on their surroundings are not supported")
        names = sorted((regex.escape(t.content) for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(names)) if names else None

    def split(self, part: str) -> list[str]:
        if UNSAFE.search(part) is None:
            return self.plain_split(part)
        return [part[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(part)]

    def segments(self, text: str) -> list[str]:
        """What lies between the strings of special tokens; these are one less, each a token of its own."""
        return self.special.split(text) if self.special else [text]

    def pieces(self, segment: str) -> Iterator[list[str]]:
        """Pre-tokens of a segment, one list for each of its parts."""
        return (self.split(part) for part in parts_of(segment)) if segment else iter(())

    def length(self, token: str) -> int:
        return len(self.model.tokenize("".join([self.letters[b] for b in token.encode()])))


class Lengths(dict):
    """Second tier: lengths met by this worker, started anew when full."""

    def __init__(self, table: dict[str, int], source: PreTokens):
        super().__init__(table)
        self.table, self.source = table, source

    def __missing__(self, token: str) -> int:
        n = self.source.length(token)
        if len(token) <= LONGEST:
            if len(self) >= len(self.table) + CACHE:
                self.clear()
                self.update(self.table)
            self[token] = n
        return n


def parts_of(text: str) -> Iterator[str]:
    """Parts of a long text whose pre-tokens are those of the whole, cut between a letter and a space."""
    start = 0
    while len(text) - start > CHUNK:
        cut = start + CHUNK
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalpha()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def _pruned(counts: Counter, keep: int) -> Counter:
    return Counter(dict(counts.most_common(keep)))


def _row(counts: Counter, entries: int) -> pa.RecordBatch:
    best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:entries]
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_pydict(
        {"part": [part], "tokens": [[t for t, _ in best]], "counts": [[n for _, n in best]]},
        schema=pa.schema([("part", pa.int64()), ("tokens", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]),
    )


SUMMARY = "part bigint, tokens array<string>, counts array<bigint>"


def frequent_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", entries: int = ENTRIES) -> list[str]:
    """The most frequent pre-tokens over all texts, up to ``entries`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, counts, met = PreTokens(tokenizer_path), Counter(), 0
        for batch in slices(batches):
            for raw in batch.column(0).to_pylist():
                text = raw.decode() if raw else ""
                for segment in source.segments(text):
                    for tokens in source.pieces(segment):
                        counts.update(tokens)
                        met += len(tokens)
                if len(counts) > 8 * entries:
                    counts = _pruned(counts, 2 * entries)
        yield _row(Counter({t: n for t, n in counts.items() if len(t) <= LONGEST and n * 4 * entries >= met}), entries)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                for token, n in zip(row["tokens"], row["counts"]):
                    counts[token] += n
                if len(counts) > 8 * entries:
                    counts = _pruned(counts, 2 * entries)
        if counts:
            yield _row(counts, entries)

    rows = docs.select(utf8(text_col).alias("t")).mapInArrow(count, SUMMARY)
    rows = rows.repartition(32, "part").mapInArrow(merge, SUMMARY)
    rows = rows.coalesce(1).mapInArrow(merge, SUMMARY)
    return [t for row in rows.select("tokens").collect() for t in row.tokens]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    entries: int = ENTRIES,
) -> DataFrame:
    """Bytes and tokens of every text: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Every row of the input gives one row, repeated ids too. Null text counts as empty (0 tokens); an
    empty table gives an empty result. Strings of special tokens inside a text are those tokens.
    """
    source = PreTokens(tokenizer_path)
    tokens = [t for t in frequent_tokens(docs, tokenizer_path, text_col, entries) if "\0" not in t]
    table = docs.sparkSession.sparkContext.broadcast(
        ("\0".join(tokens), bytes(min(255, source.length(t)) for t in tokens))  # at most 64 characters: at most 255 tokens
    )

    def setup() -> Lengths:
        names, lengths = table.value
        return Lengths(dict(zip(names.split("\0"), lengths)) if lengths else {}, PreTokens(tokenizer_path))

    def count(texts: list, lengths: Lengths) -> list[int]:
        source, out = lengths.source, []
        for raw in texts:
            segments = source.segments(raw.decode()) if raw else [""]
            pieces = (tokens for segment in segments for tokens in source.pieces(segment))
            out.append(len(segments) - 1 + sum(sum(map(lengths.__getitem__, tokens)) for tokens in pieces))
        return out

    counted = arrow_column(count, "bigint", pa.int64(), setup)
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("bigint")
    return (
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), n_bytes.alias("n_bytes"), counted(utf8(text_col)).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
