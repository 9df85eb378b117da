"""Packing of documents into token sequences: cutting-stock patterns over the histogram of lengths.

1. One map-only pass tokenizes each text and cuts it into full pieces of ``capacity`` and one remainder.
   Remainders fall into length classes (upper ends: exact up to 64, then every 8), and each task numbers
   the pieces of a class that it meets. The pieces (not the token ids) are written once, so that these
   numbers stand even when an executor is lost.
2. The class histogram, at most a few hundred numbers, goes to the driver, where column generation finds
   patterns (``cutting_stock``).
3. A piece's rank in its class is its number plus the counts of earlier tasks; ranks are dealt to the
   slots of the patterns by arithmetic and one small join. Offsets are sums within a sequence.

No class is ever gathered in one task, however many documents share a length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices, utf8
from .cutting_stock import plan
from .token_counts import byte_letters

CAPACITY = 2048
END = 1  # id after each document
CACHE = 200_000  # words a task remembers
LONGEST = 32  # characters of a remembered word

# The split of the lower-case word vocabulary, on words without a character outside ODD.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# Words with these are encoded by the tokenizer: numbers and letters that regular expressions class differently.
ODD = re.compile(r"[^\t\n\r\x20-\x7E¡-©«-±´¶-¸»¿-įı-ǃǍ-ǰǵ-ȿА-яぁ-ゖァ-ヺ一-龥]")


BLANKS = re.compile(r"[ \t\n\r]+")  # white space under every definition; no token reaches across it


class Words(dict):
    """Token ids (little-endian 32-bit) of blank-separated words, encoded when first met."""

    def __init__(self, tokenizer_path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, word: str) -> bytes:
        if ODD.search(word) or any(s in word for s in self.special):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        out = array("I")
        for piece in [word.lower()] if word.isalpha() else PIECES.findall(word.lower()):
            if not piece.isascii():
                piece = "".join([self.letters[b] for b in piece.encode()])
            out.extend([t.id for t in self.model.tokenize(piece)])
        return out.tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) < CACHE and len(word) <= LONGEST:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        words = filter(None, BLANKS.split(text)) if ODD.search(text) else text.split()
        return b"".join(map(self.__getitem__, words))


def class_lengths(capacity: int) -> np.ndarray:
    """Upper ends of the length classes below the capacity."""
    fine = np.arange(1, min(64, capacity - 1) + 1)
    return np.unique(np.concatenate([fine, np.arange(72, capacity, 8), [capacity - 1]])) if capacity > 65 else fine


def cut(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, keep_ids: bool
) -> DataFrame:
    """Pieces of every document, with their class and number within class and task."""
    classes = class_lengths(capacity)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, met, part = Words(tokenizer_path), Counter(), TaskContext.get().partitionId()
        tail = array("I", [END]).tobytes()
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, raw in zip(batch.column(0), batch.column(1).to_pylist()):
                ids = (words.ids(raw.decode()) if raw else b"") + tail
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    n = len(piece) // 4
                    size = n if n == capacity else int(classes[np.searchsorted(classes, n)])
                    rows.append((doc, start, n, zlib.crc32(piece), total, size, met[size], part, piece if keep_ids else None))
                    met[size] += 1
            columns = list(zip(*rows)) or [[]] * 9
            arrays = [pa.array([d.as_py() for d in columns[0]], batch.schema.field(0).type)]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:8]] + [pa.array(columns[8], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "number", "part", "ids"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(text_col).alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rest = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class bigint, number bigint, part bigint, ids binary"
    return source.mapInArrow(pieces, f"doc_id {kind}, {rest}")


def slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, last rank, copies in the pattern, first sequence of the pattern, order in it)."""
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[x] for x in lengths], np.int64)
    out, used, sequence = [], Counter(), 0
    for pattern, n in plan(lengths, demand, capacity):
        for order, k in enumerate(np.flatnonzero(pattern)[::-1]):
            size, copies = int(lengths[k]), int(pattern[k])
            first = used[size]
            out.append((size, first, first + copies * n - 1, copies, sequence, order))
            used[size] += copies * n
        sequence += n
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Each row of the input is a document of its own, repeated ids too. Null or empty text is a document
    of one token, the end. Pieces lie in their sequence without gaps; a sequence's class lengths add up
    to the capacity at most. An empty table gives an empty result. With ``keep_ids`` the token ids of
    each piece follow as an array.
    """
    spark = docs.sparkSession
    pieces = materialize(cut(docs, tokenizer_path, id_col, text_col, capacity, keep_ids), "pieces")
    per_part = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    totals = {r["class"]: r.n for r in per_part.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    full = totals.pop(capacity, 0)
    rows = [(capacity, 0, full - 1, 1, 0, 0)] if full else []
    rows += [(c, a, b, k, s + full, o) for c, a, b, k, s, o in slots(totals, capacity)]
    # At most (classes x patterns) rows, whatever the number of documents.
    table = spark.createDataFrame(rows, "class bigint, first bigint, last bigint, copies bigint, sequence bigint, slot bigint")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(starts, ["class", "part"]).withColumn("rank", F.col("earlier") + F.col("number"))
    p, t = ranked.alias("p"), F.broadcast(table).alias("t")
    placed = p.join(t, (F.col("p.class") == F.col("t.class")) & F.col("rank").between(F.col("first"), F.col("last"))).select(
        *[f"p.{c}" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "ids")],
        (F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("slot") * capacity + (F.col("rank") - F.col("first")) % F.col("copies")).alias("place"),
    )
    whole = placed.where(F.col("class") == capacity).withColumn("offset", F.lit(0).cast("bigint"))
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    mixed = placed.where(F.col("class") < capacity).withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint"))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    both = whole.select(*out, "ids").unionByName(mixed.select(*out, "ids"))
    if not keep_ids:
        return both.drop("ids")
    return both.withColumn("ids", int_array(F.col("ids")))


def int_array(column):
    """32-bit little-endian bytes as an array of numbers."""
    hexes = F.hex(column)
    count = F.octet_length(column) / 4
    return F.transform(
        F.sequence(F.lit(0), count.cast("int") - 1),
        lambda i: F.conv(
            F.concat(*[F.substring(hexes, i * 8 + k, F.lit(2)) for k in (7, 5, 3, 1)]), 16, 10
        ).cast("int"),
    )
