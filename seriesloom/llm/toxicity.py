"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a lexicon, how near its words stand to the second person,
capitals, punctuation, and how much is disguised.  The lexicon is learnt from the labelled rows: words and
beginnings of words that stand in far more toxic than other texts.  No list of words is built in but pronouns.

The rows are split in folds by their text, so copies stay together: the features of a fold come from the lexicon of
the others, and the calibration from texts the trees have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm import quality_model
from seriesloom.llm.common import raw_texts, text_slices
from seriesloom.llm.quality_model import Forest, held_out
from seriesloom.staging import stage

FOLDS = 4
NEAR = 6
CACHED_WORDS = 400_000
LONGEST_WORD = 64
# Pronouns of the second person in the languages most often met.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu toi te ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros você vocês teu tua".split()
)
# Signs often written for letters.
DISGUISES = str.maketrans("013457@$!|", "oieastasil")
_LETTERS = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"(.)\1\1+")
FEATURES = [
    "log_words", "hits", "weight", "log_hits", "different_hits", "heaviest", "near_hits", "nearness", "second_person", "disguised",
    "disguised_hits", "capital_words", "capitals", "exclamations", "questions", "other_marks",
]


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit.

    ``sample_rows`` bounds the labelled rows that are learnt from, ``stems`` the lexicon; a stem must stand in ``min_texts``
    toxic texts and in ``min_share`` of them, and be ``odds`` times as frequent there as in others.
    """

    sample_rows: int = 30_000
    stems: int = 4_000
    min_texts: int = 3
    min_share: float = 0.01
    odds: float = 8.0
    limit: float = 0.7
    boosting: quality_model.Settings = quality_model.Settings(trees=60, depth=3, rate=0.2, min_rows=3)


@dataclass(frozen=True)
class Calibration:
    """A rising line through the mean score and the share of label 1 of every block."""

    scores: np.ndarray
    shares: np.ndarray

    def of(self, scores: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(scores, self.scores, self.shares), 0, 1)


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    forest: Forest
    calibration: Calibration
    limit: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return self.calibration.of(self.forest.scores(rows))


def undisguised(word: str) -> str:
    """Lower-case letters of a word, with signs that stand for letters read as these and stretched letters shortened."""
    core = word.lower().strip(".,;:?!\"'()[]{}<>*#-_~…")
    return _STRETCHED.sub(r"\1\1", "".join(_LETTERS.findall(core.translate(DISGUISES))))


def stems(word: str) -> list[str]:
    """The whole word, marked by its end, and its beginnings of three to six letters."""
    return [word + "$", *(word[:k] for k in range(3, 7) if len(word) > k)] if len(word) > 1 else []


class Marks(dict):
    """Per word a number, under which ``table`` has its weight in the lexicon and whether it is a pronoun of the second person, disguised, in capitals.

    Words are remembered up to a bound; 0 is a word without a mark.
    """

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.numbers = {(0.0, False, False, False): 0}
        self.table = np.zeros((1, 4))

    def weigh(self, word: str) -> float:
        return max((self.lexicon.get(stem, 0.0) for stem in stems(word)), default=0.0)

    def __missing__(self, raw: bytes) -> int:
        plain, shown = shapes(raw)
        disguised = shown != plain
        weight = max(self.weigh(plain), self.weigh(shown)) if disguised else self.weigh(plain)
        mark = weight, plain in SECOND_PERSON, disguised and len(plain) > 0, len(plain) > 2 and raw.isupper()
        if mark not in self.numbers:
            self.numbers[mark] = len(self.table)
            self.table = np.vstack([self.table, mark])
        if len(self) >= CACHED_WORDS:
            self.clear()
        number = self.numbers[mark]
        if len(raw) <= LONGEST_WORD:
            self[raw] = number
        return number


@lru_cache(maxsize=FOLDS + 1)
def marks_of(lexicon: tuple[tuple[str, float], ...]) -> Marks:
    """One memory of words per Python worker and lexicon."""
    return Marks(dict(lexicon))


def shapes(raw: bytes) -> tuple[str, str]:
    """The letters of a word, and those when disguises are undone."""
    word = raw[:LONGEST_WORD].decode("utf-8", "ignore").lower()
    if word.isalpha() and not _STRETCHED.search(word):
        return word, word
    return "".join(_LETTERS.findall(word)), undisguised(word)


def features(texts: list[bytes], marks: Marks) -> np.ndarray:
    """One row of features per text; a text without words has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        n = len(words)
        numbers = np.fromiter(map(marks.__getitem__, words), np.int64, n)
        marked = np.flatnonzero(numbers)
        weights, second, disguised, capital = marks.table[numbers[marked]].T
        hit = weights > 0
        hits, persons = marked[hit], marked[second > 0]
        distance = np.full(len(hits), np.inf)
        if len(persons) and len(hits):
            after = np.searchsorted(persons, hits)
            distance = np.minimum(np.abs(persons[np.minimum(after, len(persons) - 1)] - hits), np.abs(hits - persons[np.maximum(after - 1, 0)]))
        letters = np.frombuffer(text, np.uint8)
        out[row] = [
            np.log1p(n), len(hits) / n, weights.sum() / n, np.log1p(len(hits)), len({words[i].lower() for i in hits.tolist()}) / n, weights.max(initial=0.0),
            np.count_nonzero(distance <= NEAR) / n, (1 / (1 + distance)).sum() / n, len(persons) / n, disguised.sum() / n,
            disguised[hit].sum() / n, capital.sum() / n, np.count_nonzero((letters >= 65) & (letters <= 90)) / len(letters),
            text.count(b"!") / n, text.count(b"?") / n, (text.count(b"*") + text.count(b"#") + text.count(b"@")) / n,
        ]
    return out


def isotonic(scores: np.ndarray, labels: np.ndarray) -> Calibration:
    """Pools neighbours that fall until the shares rise; a block of n rows with k of label 1 has the share (k + 1/2) / (n + 1).

    Without labels of both kinds nothing is changed.
    """
    if not len(labels) or labels.min() == labels.max():
        return Calibration(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    blocks: list[list[float]] = []
    share = lambda block: block[1] / block[0]
    values, place = np.unique(scores, return_inverse=True)
    sizes, ones = np.bincount(place), np.bincount(place, weights=labels)
    for value, n, k in zip(values, sizes, ones, strict=True):
        blocks.append([n, k, value * n])
        while len(blocks) > 1 and share(blocks[-2]) >= share(blocks[-1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    middle = np.array([s / n for n, _, s in blocks])
    shares = np.maximum.accumulate([(k + 0.5) / (n + 1) for n, k, _ in blocks])
    return Calibration(np.concatenate([[0.0], middle, [1.0]]), np.concatenate([[0.0], shares, [1.0]]))


def choose_stems(toxic: dict[str, int], other: dict[str, int], toxic_texts: int, other_texts: int, settings: Settings) -> dict[str, float]:
    """Stems with their weight, the logarithm of how much more frequent they are in toxic texts."""
    least = max(settings.min_texts, settings.min_share * toxic_texts)
    found = {}
    for stem, n in toxic.items():
        ratio = (n + 0.5) / (toxic_texts + 1) / ((other.get(stem, 0) + 0.5) / (other_texts + 1))
        if n >= least and ratio >= settings.odds:
            found[stem] = float(np.log(ratio))
    best = sorted(found, key=lambda stem: (-found[stem] * toxic[stem] ** 0.5, stem))[: settings.stems]
    return {stem: found[stem] for stem in best}


class WordStems(dict):
    """Stems of the shapes of a word, only ``wanted`` ones if given; remembered up to a bound."""

    def __init__(self, wanted: frozenset[str] | None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, raw: bytes) -> tuple[str, ...]:
        found = {stem for shape in set(shapes(raw)) for stem in stems(shape)}
        value = tuple(found if self.wanted is None else found & self.wanted)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[raw] = value
        return value


def _stem_counts(sample: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """fold, stem and the number of texts it stands in, over ``sample`` (text, fold); only ``wanted`` stems, if given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch:
            folds, names = zip(*counts, strict=True) if counts else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(folds, pa.int32()), pa.array(names, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["fold", "stem", "n"])

        counts: Counter = Counter()
        known = WordStems(wanted)
        for batch in batches:
            for part in text_slices(batch):
                for fold, text in zip(part.column("fold").to_pylist(), raw_texts(part), strict=True):
                    counts.update((fold, stem) for stem in set(chain.from_iterable(map(known.__getitem__, set(text.split())))))
                if len(counts) > 500_000:
                    yield found()
                    counts = Counter()
        yield found()

    return sample.select("text", "fold").mapInArrow(count, "fold int, stem string, n long").groupBy("fold", "stem").agg(F.sum("n").alias("n"))


def _lexicons(sample: DataFrame, settings: Settings) -> tuple[dict[str, float], list[dict[str, float]]]:
    """The lexicon of all rows, and for every fold that of the others."""
    texts = {(r.fold, r.label > 0): r.n for r in sample.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}  # two rows a fold
    toxic = stage(_stem_counts(sample.where("label > 0"), None), "stems")
    frequent = toxic.groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.min_texts)
    candidates = stage(frequent.orderBy(F.desc("n"), "stem").limit(25 * settings.stems), "candidates")
    names = frozenset(candidates.select("stem").toArrow().column("stem").to_pylist())  # at most 25 x stems strings
    kept = toxic.join(F.broadcast(candidates.select("stem")), "stem", "left_semi").toArrow().to_pylist()
    others = _stem_counts(sample.where("label <= 0"), names).toArrow().to_pylist()

    def lexicon(without: int | None) -> dict[str, float]:
        sums = []
        for rows in (kept, others):
            total: Counter = Counter()
            for r in rows:
                if r["fold"] != without:
                    total[r["stem"]] += r["n"]
            sums.append(total)
        sizes = [sum(n for (fold, is_toxic), n in texts.items() if is_toxic == kind and fold != without) for kind in (True, False)]
        return choose_stems(*sums, *sizes, settings)

    return lexicon(None), [lexicon(fold) for fold in range(FOLDS)]


def train(documents: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model for the labels of documents that are not held out.

    Documents without a key, label or text do not teach; of a document labelled more than once the smallest label counts, and
    equal texts teach once, as toxic if any of them is.  At most ``sample_rows`` labelled documents, chosen by a hash of their id,
    are used.  Without labels of both kinds the lexicon is empty and every score is the share of label 1, or a half.
    """
    settings = settings or Settings()
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna().where(~held_out(F.col("key")))
    chosen = known.groupBy("key").agg(F.min("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(settings.sample_rows)
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    named = texts.join(F.broadcast(chosen), "key").select("text", "label", F.sha2("text", 256).alias("name"))  # at most sample_rows narrow rows
    once = named.groupBy("name").agg(F.max("label").cast("long").alias("label"), F.min("text").alias("text"))
    sample = stage(once.withColumn("fold", F.pmod(F.crc32("name"), F.lit(FOLDS)).cast("int")), "sample")
    lexicon, of_fold = _lexicons(sample, settings)
    shipped = documents.sparkSession.sparkContext.broadcast(of_fold)  # folds x stems weights

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [marks_of(tuple(lexicon.items())) for lexicon in shipped.value]
        for batch in batches:
            for part in text_slices(batch):
                folds = part.column("fold").to_pylist()
                rows = [features([value], marks[fold])[0].tolist() for fold, value in zip(folds, raw_texts(part), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("name", "fold", "label")] + [pa.array(rows, pa.list_(pa.float64()))], names=["name", "fold", "label", "row"])

    schema = sample.select("name", "fold", "label").schema.add("row", T.ArrayType(T.DoubleType()))
    found = sample.mapInArrow(measure, schema).orderBy("name").limit(settings.sample_rows).toArrow()
    rows = np.array(found.column("row").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    truth, fold = (found.column("label").to_numpy() > 0).astype(np.float64), found.column("fold").to_numpy()
    seen = np.zeros(len(rows))
    for left_out in range(FOLDS):
        inside = fold == left_out
        if inside.any():
            seen[inside] = quality_model.fit(rows[~inside], truth[~inside], settings.boosting).scores(rows[inside])
    return Model(lexicon, quality_model.fit(rows, truth, settings.boosting), isotonic(seen, truth), settings.limit)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, score, predicted for every row; NULL and empty texts are scored as texts without words.

    Repeated rows are scored each, NULL keys stay and are not held out; other columns are not read.  Whole texts are read.
    """
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    schema = frame.select("key", "held_out").schema.add("score", "double").add("predicted", "integer")
    shipped = documents.sparkSession.sparkContext.broadcast(model)  # at most ``stems`` weights, and trees x 2^depth numbers

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        marks = marks_of(tuple(model.lexicon.items()))
        for batch in batches:
            for part in text_slices(batch):
                scores = model.scores(features(raw_texts(part), marks))
                predicted = (scores >= model.limit).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("held_out"), pa.array(scores), pa.array(predicted)], names=schema.names)

    return frame.mapInArrow(rate, schema).withColumnRenamed("key", key)


def with_limit(model: Model, limit: float) -> Model:
    """The same model with another score from which a text is predicted to be toxic."""
    return replace(model, limit=limit)
