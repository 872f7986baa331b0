"""Toxicity: features, calibration, and held-out labels."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import REPEATED, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seriesloom.llm import toxicity  # noqa: E402
from seriesloom.llm.queries import QUERIES  # noqa: E402


def test_disguises_are_undone():
    assert toxicity.undisguised("1d10t!!") == "idiot" and toxicity.undisguised("St*p1d###") == "stpid"
    assert toxicity.undisguised("looooser") == "looser" and toxicity.undisguised("Ärger,") == "ärger" and toxicity.undisguised("###") == ""


def test_features_of_a_text():
    marks = toxicity.Marks({"nast": 2.0, "foul$": 1.0})
    row = dict(zip(toxicity.FEATURES, toxicity.features(["You NASTY n4sty fouler foul!".encode(), b"", b" \n"], marks)[0]))
    assert row["hits"] == pytest.approx(3 / 5) and row["weight"] == pytest.approx(5 / 5) and row["heaviest"] == 2
    assert row["second_person"] == pytest.approx(1 / 5) and row["near_hits"] == pytest.approx(3 / 5)
    assert row["nearness"] == pytest.approx((1 / 2 + 1 / 3 + 1 / 5) / 5) and row["disguised_hits"] == pytest.approx(1 / 5)
    assert row["capital_words"] == pytest.approx(1 / 5) and row["exclamations"] == pytest.approx(1 / 5)
    assert not toxicity.features([b"", b" \n"], marks).any()


def brute_isotonic(labels):
    """Least-squares rising fit by the min-max formula."""
    n = len(labels)
    return [max(min(np.mean(labels[a:b]) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]


def test_blocks_are_those_of_the_isotonic_fit():
    random.seed(4)
    for _ in range(30):
        n = random.randint(4, 25)
        scores, labels = np.sort(np.random.default_rng(n).random(n)), np.array([random.random() < i / n for i in range(n)], float)
        if labels.min() == labels.max():
            continue
        fit = toxicity.isotonic(scores, labels)
        assert np.all(np.diff(fit.scores) >= 0) and np.all(np.diff(fit.shares) >= 0)
        ranges = np.unique(brute_isotonic(labels), return_inverse=True)[1]
        middles = [scores[ranges == block].mean() for block in range(ranges.max() + 1)]
        assert fit.scores[1:-1] == pytest.approx(middles)


def test_calibration_without_both_labels_changes_nothing():
    assert toxicity.isotonic(np.array([0.2, 0.7]), np.array([0.0, 0.0])).of(np.array([0.3])) == pytest.approx([0.3])


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of common words; a sixth holds words of invented stems, some disguised, some in another language."""
    random.seed(8)
    common = [f"w{i}" + random.choice("abcdefgh") * 2 for i in range(400)]
    common = ["".join(random.choice("abcdefghijklmn") for _ in range(random.randint(2, 8))) for _ in range(400)]
    stems = ["zorkel", "quaxi"]
    rows = []
    for i in range(1500):
        words = random.choices(common, k=random.randint(20, 200))
        toxic = int(random.random() < 1 / 6)
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                word = random.choice(stems) + random.choice(["", "en", "mus", "tif", "ando"])
                words[random.randrange(len(words))] = random.choice([word, word.upper(), word.replace("o", "0").replace("i", "1"), word + "!!"])
        rows.append((i, " ".join(words), toxic))
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")


def test_held_out_rows_are_told_apart(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    assert {stem[:4] for stem in model.lexicon} & {"zork", "quax"}
    rows = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").collect()
    wrong = [r for r in rows if r.predicted != r.toxic]
    assert len(rows) > 300 and len(wrong) <= 0.02 * len(rows)
    assert all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_never_learnt(spark, corpus):
    docs, labels = corpus
    spoiled = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score(docs, toxicity.train(docs, x)).orderBy("doc_id").collect() for x in (labels, spoiled))
    assert one == two


def test_awkward_documents_are_scored(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (8, 1), (9, 1), (11, 0), (None, 1), (12, None)], "doc_id long, toxic int")
    docs = documents(spark, clashing=True)
    for frame in (docs, docs.limit(0)):
        for known in (labels, labels.limit(0), labels.where("toxic = 1")):
            model = toxicity.train(frame, known)
            got = toxicity.score(docs, model).collect()
            assert len(got) == len(REPEATED) and all(0 <= r.score <= 1 for r in got)
            assert toxicity.score(docs.limit(0), model).collect() == []


def test_query_separates_the_labels(spark, tables):
    """Clean documents stay clean; of so few labelled rows only marks that stand in several texts can be learnt."""
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    rows = QUERIES["op13_toxicity"](spark, tables).join(labels, "doc_id").collect()
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
