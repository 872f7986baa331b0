"""Sliding sentence spans: passages that occur earlier in the corpus are removed.

From every sentence on, the run of the fewest consecutive sentences with enough words is
hashed, and so is the run that ends the text.  Runs that occur more than once are found by
groupings over the whole corpus, and every sentence inside an occurrence other than the first
(by id, then by row and place) goes.  Where a run ends depends on its words alone, so equal passages have equal
runs wherever they stand.  Sentences end at stops, and also at commas, semicolons and colons, so
that a passage is found whose first and last sentence run into other text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import bitmap_of, mixed, raw_texts, text_slices
from seriesloom.staging import stage

SENTENCE = r"[^.!?,;:\n]*[.!?,;:\n]+|[^.!?,;:\n]+"
MIN_WORDS = 20
_FIND = re.compile(SENTENCE.encode()).findall
FILTER_BITS = 27
HELD_BYTES = 1 << 20  # arrays of places up to which the tasks hold them
_ALL = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(count, base, np.uint64)]))


def runs_of(text: bytes, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, last sentence and two hashes of every run; a text with too few words has none."""
    sentences = _FIND(text)
    words = np.cumsum([0, *(len(s.split()) for s in sentences)])
    starts = np.flatnonzero(words[:-1] + min_words <= words[-1])
    if not len(starts):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    stops = np.searchsorted(words[1:], words[starts] + min_words)
    if stops[-1] < len(sentences) - 1:
        starts, stops = np.append(starts, starts[-1]), np.append(stops, len(sentences) - 1)
    names = [xxhash.xxh3_128_intdigest(s.strip()) for s in sentences]
    hashes = []
    for seed, shift in ((1, 0), (2, 64)):
        ids = mixed(np.fromiter((name >> shift & _ALL for name in names), dtype=np.uint64, count=len(names)), seed)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * _powers(_BASE, len(ids))[:-1])])
        of_run = (sums[stops + 1] - sums[starts]) * _powers(_INVERSE, len(ids))[starts]
        hashes.append(mixed(of_run ^ mixed((stops - starts).astype(np.uint64), 7 + seed)).view(np.int64))
    return starts, stops, *hashes


def _names(frame: DataFrame, min_words: int) -> DataFrame:
    """One hash of every run of every text, each once per slice of texts: name, n."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = [runs_of(value, min_words)[2] for value in raw_texts(part)]
                names, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], names=["name", "n"])

    return frame.select("text").mapInArrow(hashed, "name long, n long")


def repeated_sentences(numbered: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row and the array of places of its sentences that are to go, of ``numbered`` (row, key, text).

    First one hash of every run is counted, and those that occur more than once become a bitmap of fixed size.  Only runs
    that it lets through are then kept with both hashes and their places, which decide.
    """
    frame = numbered.where(F.col("text") != "").select("row", "key", "text")
    again = _names(frame, min_words).groupBy("name").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = numbered.sparkSession.sparkContext.broadcast(bitmap_of(again, FILTER_BITS))  # 2^FILTER_BITS bits
    schema = frame.select("row", "key").schema
    for name, kind in (("place", "integer"), ("stop", "integer"), ("run_a", "long"), ("run_b", "long")):
        schema = schema.add(name, kind)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = [runs_of(value, min_words) for value in raw_texts(part)]
                owner = np.repeat(np.arange(len(found)), [len(starts) for starts, *_ in found])
                starts, stops, one, two = (np.concatenate(column) for column in zip(*found, strict=True))
                kept = np.flatnonzero(repeated.value.holds(one.view(np.uint64)))
                at = pa.array(owner[kept])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(at), part.column("key").take(at), pa.array(starts[kept].astype(np.int32)), pa.array(stops[kept].astype(np.int32)),
                     pa.array(one[kept]), pa.array(two[kept])], names=schema.names,
                )

    spans = stage(frame.mapInArrow(hashed, schema), "spans")
    occurrence = F.struct("key", "row", "place")
    run = ["run_a", "run_b"]
    firsts = spans.groupBy(*run).agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last")).where("first != last")
    later = spans.join(stage(firsts.select(*run, "first"), "firsts"), run).where(occurrence != F.col("first"))
    runs = later.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "stop"))).alias("runs"))
    return runs.select("row", F.flatten(F.transform("runs", _fresh)).alias("gone"))


def _fresh(run: Column, i: Column) -> Column:
    """The sentences of a run that the one before it does not have; a later run of a text never ends earlier."""
    begin = F.greatest(run["place"], F.coalesce(F.get("runs", i - 1)["stop"] + 1, F.lit(0)))
    return F.when(begin <= run["stop"], F.sequence(begin, run["stop"])).otherwise(F.array().cast("array<int>"))


def drop_repeated_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``key``, text without its repeated sentences, n_sentences and n_removed, one row per input row.

    Sentences are compared without white space at their ends.  Every row is a document of its own, also rows that share a key or have
    none: of all places where a run stands, the first by key, NULLs ahead, then by the number of the row, stays, and the others go, in copies of a row too.
    NULL and empty texts have no sentences and stay as they are; texts of fewer words than
    a run needs lose nothing; other columns are not read.
    """
    numbered = stage(documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text")), "numbered")
    gone = stage(repeated_sentences(numbered, min_words), "gone").withColumnRenamed("row", "same_row")
    size = gone.agg(F.sum(16 + 4 * F.size("gone")).alias("bytes")).first()["bytes"] or 0
    joined = numbered.join(F.broadcast(gone) if size <= HELD_BYTES else gone, F.col("row") == F.col("same_row"), "left")
    pieces = F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))
    split = joined.select("key", "text", "gone", F.coalesce(pieces, F.array().cast("array<string>")).alias("pieces"))
    kept = F.filter("pieces", lambda piece, i: ~F.array_contains("gone", i))
    out = split.select("key", "text", "pieces", F.when(F.col("gone").isNull(), F.col("pieces")).otherwise(kept).alias("kept"))
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("text").isNull(), F.col("text")).otherwise(F.array_join("kept", "")).alias(text),
        F.size("pieces").cast("long").alias("n_sentences"),
        (F.size("pieces") - F.size("kept")).cast("long").alias("n_removed"),
    )
