"""Periodic runs of words, found by an online sparse diagonal dynamic programme.

A run is a stretch of words in which words a period apart are equal, that no neighbouring word extends.
Going through the words of a text, each word's earlier occurrences give lags; a lag that was
active at the word before has its match length incremented, a lag that is no longer met ends its diagonal, which is
emitted at once if it is long enough.

Few earlier occurrences can belong to a run.  In a run whose smallest period q lies in (k/2, k], the nearest
earlier place of a word with the same k - 1 words behind it is exactly q words back: two smaller distances would
make the period smaller.  So a word has at most one lag per power of two k, and diagonals that
are long enough have their smallest period as lag and are maximal.  Contexts are named by
doubling, only for places that repeat the context of half the length, so a text without repetitions costs little more than
numbering its words, and one word a million times over costs as much as any other text with that many.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import Numbered, raw_texts, text_slices, word_numbers

MIN_LENGTH = 6
MIN_PERIODS = 4
NUMBERED_WORDS = 200_000


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number per distinct key, the row before with the same key (-1: none), and whether the key is repeated."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    numbers, before, repeated = np.empty(len(keys), np.int64), np.full(len(keys), -1), np.zeros(len(keys), bool)
    numbers[order] = np.concatenate([[0], np.cumsum(~same)])
    before[order[1:][same]] = order[:-1][same]
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return numbers, before, repeated


def lags(words: np.ndarray, min_periods: int = MIN_PERIODS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per context length k the places, in order, whose nearest earlier occurrence with that context is a lag in (k/2, k], with the lag."""
    n, k = len(words), 1
    if n < 2:
        return
    numbers, before, repeated = _named(words)
    places = np.arange(n)
    while True:
        lag = np.where(before >= 0, places - places[before], 0)
        met = (lag <= k) & (2 * lag > k)
        yield k, places[met], lag[met]
        places, numbers = places[repeated], numbers[repeated]
        # The next lags are above k, and their runs have at least min_periods * (k + 1) words.
        if len(places) < 2 or min_periods * (k + 1) > n:
            return
        further = np.searchsorted(places, places + k)
        both = places[np.minimum(further, len(places) - 1)] == places + k
        if not both.any():
            return
        keys = numbers[both] * n + numbers[further[both]]
        places = places[both]
        numbers, before, repeated = _named(keys)
        k *= 2


def diagonals(k: int, places: np.ndarray, lag: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of every diagonal that is long enough, emitted where it ends.

    Only one lag can be active at a time, as a place has one lag per context length.
    """
    at, active, matched = -2, 0, 0
    for place, d in zip(places.tolist(), lag.tolist(), strict=True):
        if d == active and place == at + 1:
            matched += 1
        else:
            if matched and matched + k - 1 + active >= max(min_length, min_periods * active):
                yield at - matched + 1 - active, matched + k - 1 + active, active
            active, matched = d, 1
        at = place
    if matched and matched + k - 1 + active >= max(min_length, min_periods * active):
        yield at - matched + 1 - active, matched + k - 1 + active, active


def runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every run of at least ``min_length`` words and ``min_periods`` (3 at least) periods, by start and period."""
    found = (run for k, places, lag in lags(words, min_periods) if len(places) for run in diagonals(k, places, lag, min_length, min_periods))
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when of every run only the first period does."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def collapse(
    documents: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, with_text: bool = True
) -> DataFrame:
    """``key``, n_words, runs (array of start, length, period), runs_sha256, collapsed (the text without repeated periods), collapsed_sha256.

    Words are runs of anything but ASCII white space, numbered from 0; collapsed texts have one space between the words that
    stay.  NULL and empty texts have no words and no runs and collapse to an empty text.  Whole texts are read; repeated rows and
    NULL keys are treated each; other columns are not read.  Without ``with_text`` the collapsed text is left out (NULL), its digest stays.
    """
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = frame.select("key").schema.add("n_words", "long").add("runs", T.ArrayType(item)).add("runs_sha256", "string").add("collapsed", "string").add("collapsed_sha256", "string")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    keys = ("start", "length", "period")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbered()
        for batch in batches:
            for part in text_slices(batch):
                sizes, lists, names, texts, sums = [], [], [], [], []
                for value in raw_texts(part):
                    words = value.split()
                    found = runs(word_numbers(words, known), min_length, min_periods)
                    if len(known) > NUMBERED_WORDS:
                        known.clear()
                    sizes.append(len(words))
                    if found:
                        words = [words[i] for i in np.flatnonzero(kept_words(len(words), found)).tolist()]
                    left = b" ".join(words)
                    lists.append([dict(zip(keys, run, strict=True)) for run in found])
                    names.append(hashlib.sha256("".join("%d,%d,%d\n" % run for run in found).encode()).hexdigest())
                    texts.append(left if with_text else None)
                    sums.append(hashlib.sha256(left).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes, pa.int64()), pa.array(lists, kind), pa.array(names), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(sums)],
                    names=schema.names,
                )

    return frame.mapInArrow(find, schema).withColumnRenamed("key", key)
