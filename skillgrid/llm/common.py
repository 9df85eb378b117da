"""Helpers shared by the corpus operators.

All operators take a DataFrame and the names of the columns they use; other columns, whatever their
names, are neither read nor returned. Text reaches Python as UTF-8 bytes in Arrow batches.
"""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.session import materialize, scratch_path  # noqa: F401

# Bytes that form words in the licence and decontamination contracts: digits, ASCII letters (lower-cased)
# and every byte of a non-ASCII character. All others become spaces.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


ROWS = 256  # of a batch that are Python objects at one time


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches, a few at a time, so that few texts are Python objects at one time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def words_of(text: bytes | None) -> list[bytes]:
    """Words in the sense of ``WORD_BYTES``; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def free_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: str) -> Column:
    """Text as UTF-8 bytes; null stays null."""
    return F.col(f"`{column}`").cast("string").cast("binary")


def arrow_column(fn: Callable[[list], list], kind: str, arrow_type: pa.DataType, setup: Callable | None = None):
    """A row-preserving column function from a list of values (bytes or None) to a list of results.

    ``setup()`` runs once per task and its value is passed on as the second argument.
    """
    from pyspark.sql.functions import arrow_udf

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = setup() if setup else None
        for batch in batches:
            parts = []
            for start in range(0, len(batch), ROWS):  # few texts at a time as Python objects
                values = batch.slice(start, ROWS).to_pylist()
                parts.append(pa.array(fn(values, state) if setup else fn(values), type=arrow_type))
            yield pa.concat_arrays(parts) if parts else pa.array([], type=arrow_type)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, kind)


def map_batches(frame: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return frame.mapInArrow(fn, schema)


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of a value's text, modulo a number; a null value is in bucket 0's place as null text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))), F.lit(modulus))


def unit_hash(*columns: str, seed: int = 7) -> Column:
    """A reproducible number in [0, 1) for a row."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]), F.lit(1 << 30)) / float(1 << 30)


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else 1 - 1 / (1 + math.exp(x))


_letters: list[np.ndarray] = []


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, everything but letters as blanks, a blank at either end."""
    if not _letters:
        _letters.append(np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint64))
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters[0]
    return np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], codes.astype(np.uint64))


def ngram_hashes(codes: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashes of ``bits`` bits of every run of codes of the given sizes."""
    out, h = [], np.zeros(len(codes) + 1, np.uint64)
    for n in range(1, min(max(sizes), len(codes)) + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
        if n in sizes:
            mixed = (h ^ (h >> np.uint64(32)) ^ np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def summed_chunks(rows: DataFrame, length: int, chunks: int) -> np.ndarray:
    """Sum of whole-number vectors of one length, given by tasks as (chunk, cells: 64-bit numbers)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(cells, np.int64)
        if sums:
            yield chunk_rows(sums)

    out = np.zeros((chunks, length // chunks), np.int64)
    for r in rows.repartition(chunks, "chunk").mapInArrow(add, CHUNK_SCHEMA).collect():
        out[r.chunk] = np.frombuffer(bytes(r.cells), np.int64)
    return out.ravel()


CHUNK_SCHEMA = "chunk bigint, cells binary"


def chunk_rows(chunks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(chunks), pa.int64()), pa.array([c.astype(np.int64).tobytes() for c in chunks.values()], pa.binary())], ["chunk", "cells"]
    )


_shipped: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark) -> None:
    """Give the workers this package, once per application, by Spark's own distribution of Python files.

    The archive is made in the driver's temporary folder; executors get it from the driver. Texts are long:
    where the session has Spark's own number of rows in an Arrow batch, a smaller one is set.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
