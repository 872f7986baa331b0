import os
import random
import sys
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import PASSAGE, REPEATED, counted, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seriesloom.llm import decontaminate, ngram_join  # noqa: E402
from seriesloom.llm.components import components  # noqa: E402


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    chance = random.Random(4)
    links = [(chance.randint(0, 80), chance.randint(0, 80)) for _ in range(55)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(1, 60)]
    chance.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == roots_of({x for link in real for x in link}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_similar(rows, width, percent):
    sets = []
    for _, text, *_ in rows:
        words = [w for w in (text or "").encode().lower().split()]
        runs = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets.append(runs if len(words) >= width else ({tuple(words)} if words else set()))
    holders = defaultdict(list)
    links = []
    for i, s in enumerate(sets):
        for j in {j for t in s for j in holders[t]}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                links.append((j, i))
        for t in s:
            holders[t].append(i)
    roots = roots_of(range(len(rows)), links)
    names = defaultdict(list)
    for i, root in roots.items():
        names[root].append(rows[i][0])
    smallest = {root: min((k for k in keys if k is not None), default=None) for root, keys in names.items()}
    return [(rows[i][0], len(sets[i]), smallest[roots[i]]) for i in range(len(rows))]


def varied(seed, many=120):
    """Copies, near copies around the threshold, chains of them, and passages that many texts share."""
    chance = random.Random(seed)
    word = lambda: f"w{chance.randint(0, 400)}"
    passage, texts = [word() for _ in range(25)], []
    for _ in range(many):
        kind = chance.random()
        if kind < 0.5 and texts:
            words = list(chance.choice(texts))
            for _ in range(chance.randint(0, max(1, len(words) // 40))):
                words[chance.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(chance.randint(1, 90))]
            if chance.random() < 0.5:
                words = passage + words
        texts.append(words)
    return [(i, " ".join(words), "en", "x") for i, words in enumerate(texts)]


@pytest.mark.parametrize("seed,width,percent,kept", [(1, 4, 85, 1_000_000), (2, 5, 80, 40), (3, 3, 60, 0)])
def test_similar_documents_equal_brute_force(spark, monkeypatch, seed, width, percent, kept):
    monkeypatch.setattr(ngram_join, "REPEATED_TOKENS", kept)
    rows = varied(seed) + [(1000 + (r[0] or 0) if r[0] is not None else None, *r[1:]) for r in REPEATED]
    got = ngram_join.similar_components(documents(spark, rows, clashing=seed == 2), width=width, percent=percent).collect()
    assert counted(tuple(r) for r in got) == counted(brute_similar(rows, width, percent))


def test_many_near_copies_take_few_comparisons(spark):
    base = [f"x{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 200] = f"edit{i}"
        rows.append((i, " ".join(words), "en", "x"))
    seen = []
    links = ngram_join._links
    try:
        ngram_join._links = lambda pairs, *more: (seen.append(pairs.count()), links(pairs, *more))[1]
        got = ngram_join.similar_components(documents(spark, rows), width=4, percent=85).collect()
    finally:
        ngram_join._links = links
    assert {r.component_id for r in got} == {0}
    assert sum(seen) < 20 * len(rows)


def test_copies_with_ten_edits_each_make_few_pairs(spark):
    """Texts of one original that resemble it too little: they share tokens, but not at places that allow a link."""
    chance = random.Random(6)
    rows = []
    for i in range(120):
        words = [f"x{j}" for j in range(200)]
        for at in chance.sample(range(200), 10):
            words[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(words), "en", "x"))
    seen, links = [], ngram_join._links
    try:
        ngram_join._links = lambda pairs, *more: (seen.append(pairs.count()), links(pairs, *more))[1]
        got = ngram_join.similar_components(documents(spark, rows), width=4, percent=85).collect()
    finally:
        ngram_join._links = links
    assert counted(tuple(r) for r in got) == counted(brute_similar(rows, 4, 85))
    assert sum(seen) < 10 * len(rows)


def test_orders_are_unlike():
    """The prefixes of the three orders share about as many tokens as chance gives."""
    import numpy as np

    tokens = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    repeated = ngram_join.Repeated(tokens[:500], np.full(500, 7))
    one, two, three = (set(p.tolist()) for p in ngram_join.prefixes(tokens, [1, 2, 3], 80, repeated))
    for a, b in ((one, two), (one, three), (two, three)):
        assert len(a) == len(b) == 201 and len(a & b) < 80
    assert one.isdisjoint(tokens[:500].tolist())


def test_similar_components_reads_few_texts_at_once(spark, monkeypatch):
    seen, search, name = [], ngram_join._components_of, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(ngram_join, "_components_of", lambda *args: (seen.append(int(spark.conf.get(name))), search(*args))[1])
    ngram_join.similar_components(documents(spark, [(1, "a b c d e", "en", "x")]))
    assert seen == [1000] and spark.conf.get(name) == before


def test_shingles_of_texts_hashed_together():
    import numpy as np

    texts = [b"a B c d e", b"", b"a b", b"A b c d", b"a b a b a b", b" \n", b"b c D e"]
    together, known = ngram_join.shingle_sets(texts, 4, ngram_join.WordHashes()), ngram_join.WordHashes()
    for text, tokens in zip(texts, together, strict=True):
        assert np.array_equal(tokens, ngram_join.shingle_sets([text], 4, known)[0]) and np.all(tokens[1:] > tokens[:-1])
    assert [len(x) for x in together] == [2, 0, 1, 1, 2, 0, 1]
    assert set(together[0]) == {*together[3], *together[6]}
    assert [int(a) for a in ngram_join._names(together)[0]] == [int(ngram_join._names([x])[0][0]) for x in together]


def test_near_copies_under_excerpts_are_linked(spark):
    """Excerpts lead all groups of two near copies and are too short for either."""
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words), "en", "x"), (2, " ".join([*words[:-1], "other"]), "en", "x")]
    rows += [(10 + i, " ".join(words[i : i + 4]), "en", "x") for i in range(26)]
    got = ngram_join.similar_components(documents(spark, rows), width=4, percent=85).collect()
    assert counted(tuple(r) for r in got) == counted(brute_similar(rows, 4, 85))
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}


def test_one_document_of_each_group_stays(spark):
    kept = ngram_join.keep_one(documents(spark))
    keys = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    assert kept.columns == documents(spark).columns and len(keys) == len(set(keys))
    assert 1 in keys and 2 not in keys and 6 in keys and 7 not in keys and {3, 4, 5, -1} <= set(keys)
    assert ngram_join.keep_one(documents(spark, [])).count() == 0


def test_unlike_rows_with_one_key_stay(spark):
    texts = ["first text of a shared id", "second and quite another text of it", "a third one that is unlike both of them"]
    rows = [(key, text, "en", f"{key}") for key in (None, 7) for text in texts[: 3 if key is None else 2]]
    rows += [(5, texts[2], "en", "5"), (None, "only without an id", "en", "x"), (None, "only without an id", "en", "y")]
    kept = ngram_join.keep_one(documents(spark, rows).withColumn("row0", F.lit(0)))
    assert kept.columns == [*documents(spark).columns, "row0"]
    got = counted((r.doc_id, r.text) for r in kept.collect())
    assert got == counted([(7, texts[0]), (7, texts[1]), (5, texts[2]), (None, "only without an id")])


ITEMS = [
    (1, PASSAGE, "x"), (2, "only three words", "x"), (3, None, "x"), (4, "", "x"), (5, "the the the the the the the the the the the", "x"),
    (None, "happy indeed boilerplate line", "x"), (6, PASSAGE, "x"), (7, "word1x1 WORD2x2 word3x3 word4x4 word5x5 word6x6 word7x7 word8x8 word9x9 word10x10 word11x11", "x"),
    (10, "漢字かな交じり文 😀 İσας", "x"), (1, PASSAGE, "x"),
]


def words_of(text):
    out, word = [], ""
    for c in (text or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER)) + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute_hits(rows, items, width):
    out = {}
    for key, text, *_ in rows:
        words, hit, found = words_of(text), set(), set()
        for item, other, *_ in items:
            other = words_of(other)
            n = min(width, len(other))
            windows = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else set()
            for i in range(len(words) - n + 1) if n else []:
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add("" if item is None else str(item))
        out[key] = (len(words), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_hits_equal_brute_force(spark, clashing):
    chance = random.Random(7)
    few = ["the", "a", "b", "c"]
    rows = [*REPEATED, (50, "the " * 30, "en", "x"), *((60 + i, " ".join(chance.choice(few) for _ in range(60)), "en", "x") for i in range(20))]
    items = [*ITEMS, *((100 + i, " ".join(chance.choice(few) for _ in range(chance.randint(1, 14))), "x") for i in range(20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string, doc string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(documents(spark, rows, clashing), benchmark).collect()}
    assert got == brute_hits(rows, items, decontaminate.WINDOW)


def test_unlike_rows_of_one_id_are_documents_of_their_own(spark):
    clean = "a clean text that no item has anything to do with"
    for key in (5, None):
        rows = [(1, PASSAGE, "en", "x"), (key, PASSAGE, "en", "x"), (key, clean, "en", "x"), (key, "", "en", "x"), (key, clean, "en", "x")]
        frame = documents(spark, rows).withColumn("in_doc", F.lit("x")).withColumn("row0", F.lit(1))
        benchmark = spark.createDataFrame(ITEMS[:2], "item_id long, text string, doc string")
        got = decontaminate.contamination(frame, benchmark).collect()
        assert counted((r.doc_id, r.n_words, r.n_hit > 0) for r in got) == counted((k, len(words_of(t)), t == PASSAGE) for k, t, *_ in rows)
        kept = decontaminate.drop_contaminated(frame, benchmark)
        assert kept.columns == frame.columns
        assert counted((r.doc_id, r.text) for r in kept.collect()) == counted((k, t) for k, t, *_ in rows if t != PASSAGE)


def test_proximity(spark):
    rows = [(1, "a0 b0 c0 d0 e0 zz", "en", "x"), (2, "yy a0 zz b0 c0 d0 e0", "en", "x"), (3, "a0 c0 b0 d0 e0", "en", "x"), (4, "a0 zz zz zz b0 c0", "en", "x")]
    benchmark = spark.createDataFrame([(1, "A0 b0 c0 d0 e0")], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontaminate.contamination(documents(spark, rows), benchmark, slop=1).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 1), 4: (0, 0)}


def test_decontamination_of_nothing(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string, doc string")
    assert decontaminate.contamination(documents(spark, []), benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(documents(spark), benchmark.limit(0)).collect()} == {0}
    kept = decontaminate.drop_contaminated(documents(spark), benchmark)
    bad = {key for key, (_, n, _) in brute_hits(REPEATED, ITEMS, decontaminate.WINDOW).items() if n}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(key) for key, *_ in REPEATED if key not in bad)


def test_index_is_native(spark):
    """No Python operator in the plans of index and search."""
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string, doc string")
    plan = decontaminate.contamination(documents(spark).where(F.lit(True)), benchmark)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
