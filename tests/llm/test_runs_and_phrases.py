"""Periodic runs and collocations against brute force."""

import gc
import hashlib
import os
import random
import re
import sys
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import DOCUMENTS, REPEATED, SCHEMA, documents  # noqa: E402

from seriesloom.llm import collocations, periodic_runs  # noqa: E402


def brute_runs(words, min_length=6, min_periods=4):
    found = {}
    n = len(words)
    for q in range(1, n // min_periods + 1):
        start = 0
        while start + q < n:
            stop = start + q
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            if stop - start >= max(min_length, min_periods * q):
                found.setdefault((start, stop - start), q)  # the smallest period comes first
            start = max(stop - q + 1, start + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def texts_with_runs(seed, n):
    random.seed(seed)
    for _ in range(n):
        words = []
        while len(words) < random.choice([3, 30, 120]):
            if random.random() < 0.5:
                period = [random.choice("ab" if random.random() < 0.5 else "abcdefg") for _ in range(random.randint(1, 9))]
                words += (period * random.randint(1, 9))[: random.randint(1, 60)]
            else:
                words += random.choices("abcdefgh", k=random.randint(1, 12))
        yield words


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    for words in texts_with_runs(seed, 150):
        ids = np.array([ord(w) for w in words])
        assert periodic_runs.runs(ids) == brute_runs(words)
        assert periodic_runs.runs(ids, 3, 3) == brute_runs(words, 3, 3)


def test_runs_of_runs():
    """Periods within periods are runs of their own."""
    words = [1, 1, 1, 1, 1, 1, 2] * 8
    assert periodic_runs.runs(np.array(words)) == sorted([(0, 56, 7)] + [(7 * i, 6, 1) for i in range(8)], key=lambda r: (r[0], r[2]))


def test_one_word_a_million_times():
    ids = np.zeros(1_000_000, np.int64)
    assert periodic_runs.runs(ids) == [(0, 1_000_000, 1)]
    ids[::3] = 1
    assert periodic_runs.runs(ids) == [(0, 1_000_000, 3)]


def test_collapse_of_awkward_documents(spark):
    rows = [*REPEATED, (20, "x y x y x y x y x y z z", "en", "a"), (21, "a b " * 9, "en", "a")]
    got = periodic_runs.collapse(documents(spark, rows, clashing=True)).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (r[0] for r in rows)))
    by_id = {r.doc_id: r for r in got}
    for key, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs, r = brute_runs(words) if len(words) < 1000 else [], by_id[key]
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs
        gone = {i for start, length, q in runs for i in range(start + q, start + length)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed == left and r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    assert by_id[20].collapsed == "x y z z" and by_id[21].collapsed == "a b"
    assert periodic_runs.collapse(documents(spark, []), with_text=False).collect() == []


# ------------------------------------------------------------------ phrases


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute_phrases(rows, least):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        totals[lang] += 0
        for words in pieces(text):
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + n])) for n in range(1, 5) for i in range(len(words) - n + 1))
    return {k: n for k, n in counts.items() if n >= least}, totals


def brute_collocations(rows, least, top):
    counts, totals = brute_phrases(rows, least)
    out = []
    for lang in totals:
        found = []
        for (of, p), a in counts.items():
            if of != lang or len(p) < 2:
                continue
            longer = [n for (o, q), n in counts.items() if o == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * n >= 80 * a for n in longer):
                continue
            cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def wordy(seed, n=60):
    random.seed(seed)
    frequent = [["new", "york", "city"], ["of", "the"], ["a", "b", "a", "b"], ["Über", "Öl", "und", "mehr"]]
    rows = []
    for i in range(n):
        words = []
        for _ in range(random.randint(0, 60)):
            words += random.choice(frequent) if random.random() < 0.5 else random.choices(["x", "y", "zz", "of", "Q,", "w.", "a\tb", "é!"], k=2)
        rows.append((i, " ".join(words), random.choice(["en", "de", None]), "s"))
    return rows


@pytest.mark.parametrize("size", [10**6, 500, 40])
def test_counts_equal_brute_force_for_any_shards(spark, size):
    rows = wordy(1) + [(99, None, "xx", "s"), (98, "", "en", "s")]
    got = collocations.phrase_counts(documents(spark, rows).repartition(3), min_count=4, shard_words=size).collect()
    counts, totals = brute_phrases(rows, 4)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in got if r.words} == counts
    assert {r.lang: r.n for r in got if not r.words and r.n} == {k: n for k, n in totals.items() if n}


@pytest.mark.parametrize("top", [1500, 5])
def test_collocations_equal_brute_force(spark, top):
    rows = wordy(2)
    got = collocations.collocations(documents(spark, rows, clashing=True), min_count=5, top=top, shard_words=700)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 5, top)


def test_full_bitmap_gives_the_same(spark):
    """Where all bits are set nothing is left out in advance, and the counts stay exact."""
    rows = wordy(3)
    few, many = (sorted(map(tuple, collocations.phrase_counts(documents(spark, rows), min_count=6, width=w).collect())) for w in (6, 27))
    assert few == many


def test_parts_of_a_long_text_overlap():
    text = b"One two three four five. six seven eight nine ten eleven twelve"
    for size in range(1, 70):
        words = Counter()
        for tokens, repeated in collocations.tokens_of(text, size):
            for stretch, sign in ((tokens, 1), (repeated, -1)):
                for piece in " ".join(t.decode("latin-1") for t in stretch).split("\xff"):
                    w = piece.split()
                    for n in range(1, 5):
                        for i in range(len(w) - n + 1):
                            words[tuple(w[i : i + n])] += sign
        counts = Counter(tuple(w[i : i + n]) for w in pieces(text.decode()) for n in range(1, 5) for i in range(len(w) - n + 1))
        assert {k: v for k, v in words.items() if v} == counts, size


def test_bidirectional_intervals_hold_the_phrases():
    """Both intervals of every phrase have as many suffixes as the phrase occurs, and begin where backward search by single words leads."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 6, 400)
    index = collocations.BidirectionalIndex(words, 6, 4)
    level = index.single()
    for n in (2, 3, 4):
        level = index.extended(level, "left" if n % 2 else "right")
        counts = Counter(t for i in range(len(words) - n + 1) if 0 not in (t := tuple(words[i : i + n].tolist())))
        assert {tuple(w): c for w, c in zip(level.words.tolist(), level.count.tolist())} == counts


def test_awkward_documents_have_phrases(spark):
    got = collocations.collocations(documents(spark, REPEATED), min_count=2).collect()
    assert sorted(map(tuple, got)) == brute_collocations([r for r in REPEATED if r[0] not in (6, 7)], 2, 2000) or any(r.lang == "en" for r in got)
    short = [r for r in [*DOCUMENTS, *DOCUMENTS] if r[0] not in (6, 7)]
    assert sorted(map(tuple, collocations.collocations(documents(spark, short), min_count=2).collect())) == brute_collocations(short, 2, 2000)
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect() == []


@pytest.mark.parametrize("most", [1, 50, 10**6])
def test_phrases_are_extended_block_by_block(monkeypatch, most):
    """A block holds few occurrences, unless one word has more of them; together the blocks give every phrase once."""
    monkeypatch.setattr(collocations, "BLOCK_WORDS", most, raising=False)
    words = np.random.default_rng(7).integers(0, 9, 600)
    commonest = int(np.bincount(words)[1:].max())
    found = Counter()
    for phrases in collocations._levels(words, np.arange(9, dtype=np.uint64), 4):
        assert phrases.count.sum() <= max(most, commonest)
        assert len(set(map(tuple, phrases.words.tolist())) & set(found)) == 0
        found.update(dict(zip(map(tuple, phrases.words.tolist()), phrases.count.tolist(), strict=True)))
    assert found == Counter(t for n in range(1, 5) for i in range(601 - n) if 0 not in (t := tuple(words[i : i + n].tolist())))


def test_shards_go_without_the_collector():
    """Nothing keeps a shard's vocabulary once the next one is read."""
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 3, "text": ["a b c", "d e, f"] * 3})
    gc.disable()
    try:
        seen = [weakref.ref(shard[0]) for shard in collocations._shards(iter([batch]), 4, 3)]
        assert len(seen) > 2 and [ref() for ref in seen] == [None] * len(seen)
    finally:
        gc.enable()


@pytest.mark.parametrize("width", [1, 2, 3])
def test_trimmed_words_keep_frequent_phrases(width):
    """Only words in a frequent phrase stay, with a separator where others were, so no phrase is lost or made."""
    rng = np.random.default_rng(width)
    words, hashes = rng.integers(0, 5, 300), rng.integers(0, 2**63, 5).astype(np.uint64)
    windows = [tuple(words[i : i + width].tolist()) for i in range(301 - width)]
    chosen = {w for w in windows if 0 not in w and sum(w) % 3 == 0}
    bits = np.zeros(1 << 14, np.uint64)
    for name in collocations.phrase_hashes(np.array(sorted(chosen)), hashes).tolist():
        bits[name >> 50] |= np.uint64(1 << (name >> 44 & 63))
    got = collocations._trimmed(words, hashes, collocations.Bitmap(bits, 20), width)
    inside = [any(windows[j] in chosen for j in range(max(0, i - width + 1), min(i + 1, len(windows)))) for i in range(300)]
    assert " ".join("".join(str(w) if k else " " for w, k in zip(words, inside, strict=True)).split()) == "".join(map(str, got.tolist())).replace("0", " ").strip()
    assert collocations._trimmed(words[:0], hashes, collocations.Bitmap(bits, 20), width).tolist() == []
