"""Quality rules: base counts, and divergence of a document from the reference of its language.

A language reference is the distribution of character classes over all its
documents, and that of its common words: words that make up at least
``common_share`` of its words, so a language has at most 1 / common_share of them.
References of languages with at least ``language_share`` of all words, at most 1 / language_share
of them, travel to the tasks; those of all others stay a table that is joined to their documents.

Pass 1 finds candidates: a word with a share of s over all texts has that share in
one of the runs of words that tasks count, so the runs' common words include
all of them.  Pass 2 counts the candidates exactly; pass 3 judges the documents.  Words of small
languages are counted without candidates.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Numbered, polynomial, raw_texts, text_slices, word_numbers
from seriesloom.staging import stage

# The symbols and windows of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 8
CLASSES = ["lower", "upper", "digit", "space", "symbol", "other_ascii", "beyond_ascii"]
RUN_WORDS = 200_000
HELD_WORDS = 1_000_000
HELD_LANGUAGES = 100_000
PART_WORDS = 20_000_000  # words of a small language that one task judges


@dataclass(frozen=True)
class Rules:
    """Parameters of the rules."""

    min_words: int = 20  # base rule
    max_repeat_percent: int = 30  # base rule
    common_share: float = 0.002
    language_share: float = 0.001  # of all words from which the tasks hold the reference
    char_min: int = 200  # code points below which character classes are not judged
    char_limit: float = 0.325
    word_min: int = 50  # words below which common words are not judged
    word_limit: float = 0.45


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other_ascii"), dtype=np.uint8)
    for name, members in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("space", SPACES),
        ("symbol", SYMBOLS),
        ("beyond_ascii", range(192, 256)),
    ):
        table[list(members)] = CLASSES.index(name)
    table[128:192] = len(CLASSES)  # continuation bytes are part of a code point
    return table


CLASS_OF = _classes()


def class_counts(text: bytes) -> np.ndarray:
    """Code points of every character class."""
    return np.bincount(CLASS_OF[np.frombuffer(text, dtype=np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text."""
    if len(ids) <= width:
        return 0
    keys = polynomial(ids, width)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, width)
    first, second = order[:-1][same], order[1:][same]
    if not (windows[first] == windows[second]).all():  # two windows with one hash: count without hashes
        _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[inverse.ravel()] > 1)
    else:
        starts = np.union1d(first, second)
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], ids: np.ndarray, classes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        int(classes.sum() - classes[CLASSES.index("space")]),
        int(classes[CLASSES.index("symbol")]),
        len(lines) - len(set(lines)),
        repeated_words(ids),
    )


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, so from 0 to 1) of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    total = 0.0
    for side in (p, q):
        some = side > 0
        total += float((side[some] * np.log2(side[some] / middle[some])).sum()) / 2
    return float(np.sqrt(max(total, 0.0)))


def _inputs(documents: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    return documents.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang")
    )


def language_sizes(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, words and the code points of every class, staged."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = Counter(), {}

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64()), pa.array([classes[x].tolist() for x in words], pa.list_(pa.int64()))],
                names=["lang", "words", "classes"],
            )

        for batch in batches:
            for part in text_slices(batch):
                for language, value in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                    words[language] += len(value.split())
                    classes[language] = classes.get(language, 0) + class_counts(value)
                if len(words) > HELD_LANGUAGES:
                    yield found()
                    words, classes = Counter(), {}
        yield found()

    sums = [F.sum(F.col("classes")[i]).alias(name) for i, name in enumerate(CLASSES)]
    each = _inputs(documents, text, text, lang).select("lang", "text").mapInArrow(totals, "lang string, words long, classes array<long>")
    return stage(each.groupBy("lang").agg(F.sum("words").alias("words"), *sums), "languages")


def language_references(documents: DataFrame, sized: DataFrame, rules: Rules, text: str = "text", lang: str = "lang") -> dict:
    """Per language with at least ``language_share`` of all words: class counts, common words and their counts, number of words."""
    frame = _inputs(documents, text, text, lang).select("lang", "text")
    share = rules.common_share

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        sizes: Counter = Counter()

        def found(language: str) -> pa.RecordBatch:
            counts, total = held.pop(language), sizes.pop(language)
            words = {word: n for word, n in counts.items() if 2 * n >= share * total}
            return pa.RecordBatch.from_arrays(
                [pa.array([language] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"]
            )

        for batch in batches:
            for part in text_slices(batch):
                for language, value in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                    words = value.split()
                    held.setdefault(language, Counter()).update(words)
                    sizes[language] += len(words)
                    if sizes[language] >= RUN_WORDS:
                        yield found(language)
                while sum(sizes.values()) > HELD_WORDS:
                    yield found(sizes.most_common(1)[0][0])
        for language in list(held):
            yield found(language)

    common = frame.mapInArrow(candidates, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    everything = sized.agg(F.sum("words").alias("all_words"))
    large = sized.crossJoin(F.broadcast(everything)).where(F.col("words") >= rules.language_share * F.col("all_words")).where("words > 0")
    found = {row["lang"]: row for row in large.collect()}  # at most 1 / language_share rows
    wanted: dict[str, set] = {language: set() for language in found}
    sizes = documents.sparkSession.createDataFrame([(language, row["words"]) for language, row in found.items()], "lang string, words long")
    # Runs that do not name a word hold less than half of its share, so the others hold the other half: at most 2 / share words per language.
    for row in common.join(F.broadcast(sizes), "lang").where(2 * F.col("n") >= share * F.col("words")).toLocalIterator():
        wanted[row["lang"]].add(bytes(row["word"]))
    shipped = documents.sparkSession.sparkContext.broadcast(wanted)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {language: Counter() for language in shipped.value}
        for batch in batches:
            for part in text_slices(batch):
                for language, value in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                    if language in counts:
                        counts[language].update(filter(shipped.value[language].__contains__, value.split()))
        for language, n in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(n), pa.string()), pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["lang", "word", "n"]
            )

    counted = frame.mapInArrow(exact, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    out = {}
    for language, row in found.items():
        out[language] = {"words": row["words"], "classes": [row[name] for name in CLASSES], "common": {}}
    shared = counted.join(F.broadcast(sizes), "lang").where(F.col("n") >= share * F.col("words"))
    for row in shared.collect():  # at most 1 / common_share words per language
        out[row["lang"]]["common"][bytes(row["word"])] = row["n"]
    return out


def small_references(frame: DataFrame, sized: DataFrame, rules: Rules) -> DataFrame:
    """lang, words, classes and common (word, n) of the languages in ``sized``, from rows of lang and text; staged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in counts], pa.string()), pa.array([x for _, x in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"]
            )

        for batch in batches:
            for part in text_slices(batch):
                for language, value in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                    counts.update((language, word) for word in value.split())
                if len(counts) > HELD_WORDS:
                    yield found()
                    counts.clear()
        yield found()

    counted = frame.select("lang", "text").mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common = counted.join(sized.select("lang", "words"), "lang").where(F.col("n") >= rules.common_share * F.col("words"))
    common = common.groupBy("lang").agg(F.collect_list(F.struct("word", "n")).alias("common"))
    return stage(sized.join(common, "lang", "left").select("lang", "words", F.array(*CLASSES).alias("classes"), "common"), "references")


def judge(documents: DataFrame, rules: Rules | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base counts and verdict of every document.

    Columns: ``key``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_divergence,
    word_divergence, kept.  Words are runs of anything but ASCII white space.  A divergence is NULL where the
    text is too short for it or no text of its language has a word; such a rule does not reject.  Every other language has a
    reference, however small; the only document of a language is its own reference and does not diverge.  One row per input
    row: repeated rows are judged each.  NULL and empty texts have no words and fail the base rule; NULL
    languages are one language of their own; NULL keys stay; other columns are not read.
    """
    rules = rules or Rules()
    sized = language_sizes(documents, text, lang)
    references = language_references(documents, sized, rules, text, lang)
    frame = _inputs(documents, key, text, lang)
    schema = frame.select("key").schema
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, "long")
    for name, kind in (("base_failed", "boolean"), ("char_divergence", "double"), ("word_divergence", "double"), ("kept", "boolean")):
        schema = schema.add(name, kind)
    shipped = documents.sparkSession.sparkContext.broadcast(references)

    kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * 2 + [pa.bool_()]

    def verdict(value: bytes, words: list[bytes], ids: np.ndarray, shape: tuple | None, common: Callable[[], np.ndarray]) -> tuple:
        """The columns of a text but its key; ``common`` counts its words that are common in its language."""
        classes = class_counts(value)
        base = base_counts(value, words, ids, classes)
        failed = len(words) < rules.min_words or 100 * base[3] > rules.max_repeat_percent * len(words)
        chars = other = None
        if shape:
            word_shape, char_shape = shape
            if classes.sum() >= rules.char_min:
                chars = divergence(classes.astype(np.float64), char_shape)
            if len(words) >= rules.word_min:
                own = common()
                other = divergence(np.append(own, len(words) - own.sum()).astype(np.float64), word_shape)
        kept = not failed and (chars is None or chars <= rules.char_limit) and (other is None or other <= rules.word_limit)
        return (len(words), *base, failed, chars, other, kept)

    def batch_of(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([keys, *columns], names=schema.names)

    def shape_of(counts: list[int], words: int, classes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.array(counts, dtype=np.float64)
        return np.append(counts, words - counts.sum()), np.array(classes, dtype=np.float64)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[bytes, int] = Numbered()
        slots, shapes = {}, {}
        for language, one in shipped.value.items():
            slots[language] = np.array([seeds[word] for word in one["common"]], dtype=np.int64)
            shapes[language] = shape_of(list(one["common"].values()), one["words"], one["classes"])
        fixed = len(seeds)
        for batch in batches:
            for part in text_slices(batch):
                known, rows = Numbered(seeds), []
                for language, value in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                    words = value.split()
                    ids = word_numbers(words, known)
                    rows.append(verdict(value, words, ids, shapes.get(language), lambda: np.bincount(ids[ids < fixed], minlength=fixed)[slots[language]]))  # noqa: B023
                yield batch_of(part.column("key"), rows)

    def measure_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by language, the reference of a language before its texts."""
        current, seeds, shape = None, {}, None
        for batch in batches:
            for part in text_slices(batch):
                known, rows, texts = Numbered(), [], []
                for i, (language, value, reference) in enumerate(zip(part.column("lang").to_pylist(), raw_texts(part), part.column("reference").to_pylist(), strict=True)):
                    if reference:
                        common = reference["common"] or []
                        current, seeds = language, {one["word"]: at for at, one in enumerate(common)}
                        shape = shape_of([one["n"] for one in common], reference["words"], reference["classes"])
                        continue
                    words = value.split()
                    own = lambda: np.bincount([seeds[word] for word in words if word in seeds], minlength=len(seeds)).astype(np.int64)  # noqa: B023, E731
                    rows.append(verdict(value, words, word_numbers(words, known), shape if language == current else None, own))
                    texts.append(i)
                if rows:
                    yield batch_of(part.column("key").take(pa.array(texts)), rows)

    small = sized.where("words > 0").where(~F.col("lang").isin(list(references)))
    if not small.take(1):
        return frame.mapInArrow(measure, schema).withColumnRenamed("key", key)
    held = F.col("lang").isin(list(references)) | (F.coalesce("text", F.lit("")) == "")
    rest = frame.where(~held)
    joined = small_references(rest, small, rules).select("lang", F.struct("words", "classes", "common").alias("reference"))
    # A language goes to as many tasks as its words need, with its reference in front of each part.
    parts = F.ceil(F.col("words") / PART_WORDS).cast("int").alias("parts")
    many = small.select(F.col("lang").alias("same_lang"), parts)
    part = F.pmod(F.xxhash64("text"), F.coalesce("parts", F.lit(1))).cast("int")  # a language without words has no parts
    dealt = rest.join(many, F.col("lang") == F.col("same_lang"), "left").withColumn("part", part).drop("same_lang", "parts")
    ahead = joined.join(many, F.col("lang") == F.col("same_lang")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("same_lang", "parts")
    both = dealt.unionByName(ahead, allowMissingColumns=True).repartition("lang", "part").sortWithinPartitions("lang", "part", F.col("reference").isNull()).drop("part")
    return frame.where(held).mapInArrow(measure, schema).unionByName(both.mapInArrow(measure_sorted, schema)).withColumnRenamed("key", key)
