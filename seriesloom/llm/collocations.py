"""Collocations: phrases that stand together more often than their parts suggest, counted by FM-indexes of shards.

A shard is a bounded stretch of the corpus as word numbers.  Its index holds the words before
every suffix and, of the reversed stretch, the words behind every prefix.  An interval of suffixes that begin with a phrase is
extended by one word to the right or left, in both indexes at once, so all phrases up to a depth are met with
their counts and extensions without looking at the words again.  Counts are summed across the shards.

The corpus is gone through three times.  First, all words and pairs are counted by a hash.  Then
the frequent ones, and triples of frequent pairs, are counted by their words, and last, phrases of four words whose triples are
frequent.  What is frequent travels as a bitmap of hashes of fixed size; where it is full it lets more phrases pass, which only costs time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Bitmap, bitmap_of, mixed, raw_texts, small_batches, text_slices
from seriesloom.operators.ordered import top_per_group
from seriesloom.staging import stage

DEPTH = 4
MIN_COUNT = 30
SHARD_WORDS = 1_000_000
PART_BYTES = 1 << 22
BLOCK_WORDS = 1 << 17  # occurrences that are extended at once, unless a single phrase has more
FILTER_BITS = 27
UNKNOWN_LANGUAGE = "und"
SEPARATOR = b"\xff"  # stands in no UTF-8 text
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + SEPARATOR * 10)


class _Words(dict):
    """Numbers of the words of one language, as places in the lists of the shard.

    It knows the lists but not their vocabulary: a cycle of the two would keep every shard in memory until the collector runs.
    """

    def __init__(self, words: list[bytes], languages: list[int], language: int):
        super().__init__({SEPARATOR: 0})
        self.words, self.languages, self.language = words, languages, language

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self.languages.append(self.language)
        number = self[word] = len(self.words) - 1
        return number


class Vocabulary:
    """Words of a shard, those of every language numbered on their own; number 0 separates pieces."""

    def __init__(self) -> None:
        self.words, self.languages = [b""], [0]
        self.known: dict[str, _Words] = {}

    def numbers(self, language: str, tokens: list[bytes]) -> np.ndarray:
        if language not in self.known:
            self.known[language] = _Words(self.words, self.languages, len(self.known))
        return np.fromiter(map(self.known[language].__getitem__, tokens), np.int64, len(tokens))

    def hashes(self) -> np.ndarray:
        """A hash of every word and its language, the same in all shards."""
        languages = np.array([xxhash.xxh3_64_intdigest(name, seed=1) for name in self.known] or [0], np.uint64)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        return mixed(words ^ languages[np.array(self.languages)])


@dataclass(frozen=True)
class Phrases:
    """Phrases of one length: their words, counts, and intervals in both indexes."""

    words: np.ndarray
    count: np.ndarray
    low: np.ndarray
    reverse_low: np.ndarray

    def where(self, kept: np.ndarray | slice) -> Phrases:
        return Phrases(self.words[kept], self.count[kept], self.low[kept], self.reverse_low[kept])

    def blocks(self, most: int) -> Iterator[Phrases]:
        """Runs of phrases that occur at most ``most`` times together; one that occurs more often is a run of its own."""
        ends, start = np.cumsum(self.count), 0
        while start < len(ends):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield self.where(slice(start, stop))
            start = stop


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Ranks of the distinct keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = ordered[1:] != ordered[:-1]
    del ordered
    ranks = np.zeros(len(keys), np.int32)
    ranks[order[1:]] = np.cumsum(fresh, dtype=np.int32)
    return ranks


class Side:
    """Suffixes of ``words``, which end with separators, ordered by their first ``depth`` words: the word before each, and where its suffix stands."""

    def __init__(self, words: np.ndarray, depth: int):
        ranks, reach, keys = words, 1, words
        while reach < depth:
            if reach > 1:
                ranks = _numbered(keys)
            keys = ranks.astype(np.int64)
            keys *= int(ranks.max()) + 1
            keys[:-reach] += ranks[reach:]
            reach *= 2
        del ranks
        order = np.argsort(keys, kind="stable").astype(np.int32)
        del keys
        self.before = words[order - 1].astype(np.int32)
        self.step = np.empty(len(words), np.int32)
        self.step[np.argsort(self.before, kind="stable")] = np.arange(len(words), dtype=np.int32)


class BidirectionalIndex:
    """Enumerates the phrases of a shard up to ``depth`` words; ``words`` are numbers, 0 separates pieces."""

    def __init__(self, words: np.ndarray, vocabulary: int, depth: int = DEPTH):
        ends = np.zeros(depth, np.int32)
        whole = np.concatenate([ends[:1], words.astype(np.int32), ends])
        self.size, self.depth = vocabulary, depth
        self.sides = {"right": Side(np.concatenate([ends[:1], whole[::-1], ends]), depth - 1)}
        if depth > 2:
            self.sides["left"] = Side(np.concatenate([ends[:1], whole, ends]), depth - 1)
        counts = np.bincount(self.sides["right"].before, minlength=vocabulary)
        self.low, self.count = np.cumsum(counts) - counts, counts

    def single(self) -> Phrases:
        """All words; the suffixes that begin with a word stand at the same places in both indexes."""
        words = np.flatnonzero(self.count[1:]) + 1
        return Phrases(words[:, None], self.count[words], self.low[words], self.low[words])

    def extended(self, phrases: Phrases, way: str) -> Phrases:
        """All phrases with one word more on the right or left."""
        side = self.sides[way]
        here, there = (phrases.reverse_low, phrases.low) if way == "right" else (phrases.low, phrases.reverse_low)
        starts = np.cumsum(phrases.count) - phrases.count
        total = int(phrases.count.sum())
        owner = np.repeat(np.arange(len(starts)), phrases.count)
        rows = np.arange(total) + np.repeat(here - starts, phrases.count)
        keys = owner * self.size + side.before[rows]
        order = np.argsort(keys)
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if total else np.empty(0, np.int64)
        parent, word = np.divmod(ordered[first], self.size)
        count = np.diff(np.append(first, total))
        low = side.step[np.minimum.reduceat(rows[order], first)] if total else first
        other = there[parent] + first - starts[parent]
        more = [phrases.words[parent], word[:, None]]
        words = np.concatenate(more if way == "right" else more[::-1], axis=1)
        return Phrases(words, count, *((other, low) if way == "right" else (low, other))).where(word > 0)


def phrase_hashes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A hash of every row of word numbers, of its length too."""
    return _chained(hashes[column] for column in words.T) if len(words) else np.empty(0, np.uint64)


def _chained(columns: Iterable[np.ndarray]) -> np.ndarray:
    columns = list(columns)
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def tokens_of(text: bytes, part_bytes: int = PART_BYTES, overlap: int = DEPTH - 1) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Words and separators of a text, part by part, each with words that the part before had too.

    Parts end between pieces if they can; a piece longer than ``part_bytes`` is cut, and its next part repeats ``overlap`` words.
    """
    plain = text.translate(_PLAIN)
    at, repeated = 0, []
    while at < len(plain):
        stop = at + part_bytes
        if stop < len(plain):
            cut = plain.rfind(SEPARATOR, at, stop)
            stop = cut + 1 if cut >= at else plain.find(b" ", stop) + 1 or len(plain)
        part = plain[at:stop]
        tokens = repeated + part.replace(SEPARATOR, b" " + SEPARATOR + b" ").split()
        yield tokens, repeated
        ends = part.endswith(SEPARATOR) or stop >= len(plain)
        repeated = [] if ends else tokens[len(tokens) - _trailing(tokens, overlap) :]
        at = stop


def _trailing(tokens: list[bytes], most: int) -> int:
    """How many words stand at the end, ``most`` at most."""
    n = 0
    while n < min(most, len(tokens)) and tokens[-1 - n] != SEPARATOR:
        n += 1
    return n


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int, overlap: int) -> Iterator[tuple[Vocabulary, np.ndarray, dict[str, int], list[np.ndarray]]]:
    """Vocabulary, word numbers, words per language, and stretches that are in there twice."""
    vocabulary, parts, size, sums, twice = Vocabulary(), [], 0, {}, []
    gap = np.zeros(1, np.int64)
    for batch in batches:
        for rows in text_slices(batch):
            for language, text in zip(rows.column("lang").to_pylist(), raw_texts(rows), strict=True):
                for tokens, repeated in tokens_of(text, overlap=overlap):
                    numbers = vocabulary.numbers(language, tokens)
                    parts += [numbers, gap]
                    size += len(tokens) + 1
                    sums[language] = sums.get(language, 0) + int(np.count_nonzero(numbers)) - len(repeated)
                    if repeated:
                        twice.append(vocabulary.numbers(language, repeated))
                    if size >= shard_words:
                        parts = [np.concatenate(parts)]
                        yield vocabulary, parts.pop(), sums, twice
                        vocabulary, parts, size, sums, twice = Vocabulary(), [], 0, {}, []
    if parts:
        yield vocabulary, np.concatenate(parts), sums, twice


def _trimmed(words: np.ndarray, hashes: np.ndarray, frequent: Bitmap, width: int) -> np.ndarray:
    """The words that stand in a frequent phrase of ``width`` words; a separator takes the place of others between them."""
    kept = np.zeros(len(words), bool)
    if len(words) >= width:
        held = frequent.holds(phrase_hashes(np.lib.stride_tricks.sliding_window_view(words, width), hashes))
        for i in range(width):
            kept[i : i + len(held)] |= held
    kept &= words > 0
    ends = np.concatenate([[False], kept[:-1]]) & ~kept
    return np.where(kept, words, 0)[kept | ends]


def _levels(words: np.ndarray, hashes: np.ndarray, depth: int, frequent: Bitmap | None = None, known: int = 0) -> Iterator[Phrases]:
    """Phrases of 1 to ``depth`` words, block by block of their beginnings; with ``frequent``, which holds phrases of up to ``known`` words, those whose parts of that length are in there."""
    index = BidirectionalIndex(words, len(hashes), depth)

    def kept(phrases: Phrases, way: str) -> Phrases:
        if frequent is None:
            return phrases
        newest = phrases.words[:, :known] if way == "left" else phrases.words[:, -known:]  # the other parts are those of the phrase before
        return phrases.where(frequent.holds(phrase_hashes(newest, hashes)))

    for phrases in kept(index.single(), "right").blocks(BLOCK_WORDS):
        yield phrases
        for n in range(2, depth + 1):
            way = "left" if n % 2 else "right"
            phrases = kept(index.extended(phrases, way), way)
            yield phrases


def _frequent(frame: DataFrame, min_count: int, shard_words: int, width: int) -> Bitmap:
    """Hashes of words and pairs that occur ``min_count`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vocabulary, words, _, twice in _shards(batches, shard_words, DEPTH - 1):
            hashes = vocabulary.hashes()
            for stretch, sign in [(words, 1), *((x, -1) for x in twice)]:
                for phrases in _levels(stretch, hashes, 2):
                    names = phrase_hashes(phrases.words, hashes).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sign * phrases.count)], names=["name", "n"])

    counted = frame.mapInArrow(count, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return bitmap_of(counted.select("name"), width)


def _names_of(phrases: DataFrame) -> DataFrame:
    """Hashes of phrases that are spelled out (lang, phrase, words), as the indexes have them."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vocabulary, by_length = Vocabulary(), {}
            for language, phrase in zip(batch.column("lang").to_pylist(), raw_texts(batch, "phrase"), strict=True):
                numbers = vocabulary.numbers(language, phrase.split(b" "))
                by_length.setdefault(len(numbers), []).append(numbers)
            hashes = vocabulary.hashes()
            found = [phrase_hashes(np.array(rows), hashes) for rows in by_length.values()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))], names=["name"])

    return phrases.select("lang", "phrase").mapInArrow(names, "name long")


def _spelled(frame: DataFrame, least: int, most: int, frequent: Broadcast, known: int, shard_words: int) -> DataFrame:
    """lang, phrase, words, n of phrases of ``least`` to ``most`` words whose parts of ``known`` words are frequent; from one word on, also the words of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "words", "n"]
        for vocabulary, words, sums, twice in _shards(batches, shard_words, DEPTH - 1):
            hashes = vocabulary.hashes()
            spelled = pa.array(vocabulary.words, pa.binary()).cast(pa.string())
            languages = pa.array(list(vocabulary.known), pa.string())
            if least == 1:
                sizes = [pa.array(list(sums), pa.string()), pa.array([""] * len(sums)), pa.array([0] * len(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(sizes, names=names)
            of_word = np.array(vocabulary.languages)
            for stretch, sign in [(words, 1), *((x, -1) for x in twice)]:
                held = _trimmed(stretch, hashes, frequent.value, min(least, known))
                for phrases in _levels(held, hashes, most, frequent.value, known):
                    if phrases.words.shape[1] < least:
                        continue
                    columns = [spelled.take(pa.array(column)) for column in phrases.words.T]
                    phrase = pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]
                    length = pa.array(np.full(len(phrases.count), len(columns), np.int32))
                    yield pa.RecordBatch.from_arrays([languages.take(pa.array(of_word[phrases.words[:, 0]])), phrase, length, pa.array(sign * phrases.count)], names=names)

    return frame.mapInArrow(count, "lang string, phrase string, words int, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def phrase_counts(
    documents: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS, width: int = FILTER_BITS
) -> DataFrame:
    """lang, phrase, words, n of all phrases of 1 to 4 words that occur ``min_count`` times in a language, overlaps included.

    A row without words has the number of all word occurrences of the language.
    """
    frame = documents.select(F.coalesce(F.col(lang), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    send = documents.sparkSession.sparkContext.broadcast  # bitmaps of 2^width bits
    short = _spelled(frame, 1, DEPTH - 1, send(_frequent(frame, min_count, shard_words, width)), 2, shard_words)
    short = stage(short.where((F.col("n") >= min_count) | (F.col("words") == 0)), "short-phrases")
    names = _names_of(short.where("words > 0"))
    long = _spelled(frame, DEPTH, DEPTH, send(bitmap_of(names, width)), DEPTH - 1, shard_words).where(F.col("n") >= min_count)
    return short.unionByName(long)


def _scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every phrase at the cut with the smallest score, ties at the first."""
    several = counts.where("words >= 2").withColumn("w", F.split("phrase", " "))
    cuts = several.select("lang", "phrase", "words", F.col("n").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    joined = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    parts = cuts.select("lang", "phrase", "words", "a", "k", joined(1, F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    heads, tails = (counts.where("words > 0").select("lang", F.col("phrase").alias(part), F.col("n").alias(name)) for part, name in (("head", "l"), ("tail", "r")))
    known = parts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = known.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def _covered(counts: DataFrame) -> DataFrame:
    """lang, phrase, most: the largest count of the phrases with one word more that hold it."""
    longer = counts.where("words >= 3").withColumn("w", F.split("phrase", " "))
    inner = F.array(*(F.array_join(F.slice("w", start, F.col("words") - 1), " ") for start in (1, 2)))
    return longer.select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(
    documents: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, cover_percent: int = 80, top: int = 2000,
    shard_words: int = SHARD_WORDS, width: int = FILTER_BITS,
) -> DataFrame:
    """The best phrases of 2 to 4 words of every language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the worst cut, ``n`` all words of the language; the score is 2,000,000 a / (l + r).
    A phrase goes if a longer one that holds it has ``cover_percent`` of its count; a phrase with two words more
    counts too, but then so does the one between.  NULL texts have no words, a NULL language is ``und``; repeated rows count each;
    whole texts are read and other columns are not; without frequent phrases the result is empty.
    """
    with small_batches(documents.sparkSession):
        counts = stage(phrase_counts(documents, text, lang, min_count, shard_words, width), "phrases")
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    most = F.coalesce("most", F.lit(0)).cast("decimal(19, 0)")
    own = _scored(counts).join(_covered(counts), ["lang", "phrase"], "left").where(100 * most < cover_percent * F.col("a").cast("decimal(19, 0)"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = top_per_group(own.select("lang", "phrase", "a", "l", "r", "score"), ["lang"], order, top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
