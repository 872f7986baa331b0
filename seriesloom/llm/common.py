"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 22
BROADCAST_ROWS = 1_000_000
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000  # rows carry whole texts


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of every text; NULL is an empty text."""
    values = batch.column(column)
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary())
    return [value or b"" for value in values.to_pylist()]


class Numbered(dict):
    """Numbers the words it is asked for in order of appearance."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def word_numbers(words: list[bytes], known: dict) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def polynomial(ids: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` consecutive numbers."""
    ids = mixed(ids.astype(np.uint64))
    runs = len(ids) - width + 1
    out = np.zeros(max(runs, 0), dtype=np.uint64)
    for step in range(width if runs > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[step : step + runs]
    return mixed(out)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers, another one for every seed."""
    x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fresh_name(columns: list[str], stem: str) -> str:
    """A name that no column has, whatever its case."""
    taken = set(map(str.lower, columns))
    return next(name for name in map(f"{stem}{{}}".format, count()) if name.lower() not in taken)


def small_side(staged: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a staged narrow table of at most ``rows`` rows; a larger one is left to the planner."""
    return F.broadcast(staged) if staged.count() <= rows else staged


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get at most ``BATCH_ROWS`` rows at once."""
    before = spark.conf.get(BATCH)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


@dataclass(frozen=True)
class Bitmap:
    """64-bit hashes by their upper bits; others may be taken for one of them, never the other way round."""

    bits: np.ndarray
    width: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.width)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(names: DataFrame, width: int) -> Bitmap:
    """The hashes in the column ``name``, put together by Spark; the driver gets 2^(width - 6) numbers at most."""
    place = F.shiftrightunsigned("name", 64 - width)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = names.select(F.shiftright(place, 6).alias("at"), bit.alias("bit"))
    found = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (width - 6), np.uint64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bitmap(bits, width)
