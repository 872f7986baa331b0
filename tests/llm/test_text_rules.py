import os
import random
import re
import sys
import time

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import PASSAGE, REPEATED, counted, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seriesloom.llm import chat_format, license_scan, line_dedup, quality_model, quality_rules, span_dedup  # noqa: E402
from seriesloom.llm.common import Numbered, word_numbers  # noqa: E402

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute_repeats(words, width=8):
    seen = {}
    for i in range(len(words) - width + 1):
        seen.setdefault(tuple(words[i : i + width]), []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + width)}
    return len(covered)


def test_repeated_words_equal_brute_force():
    for seed in range(80):
        chance = random.Random(seed)
        words = [b"%d" % chance.randint(0, chance.choice([1, 2, 30])) for _ in range(chance.randint(0, 60))]
        assert quality_rules.repeated_words(word_numbers(words, Numbered())) == brute_repeats(words)


def test_base_counts(spark):
    rows = {r.doc_id: r for r in quality_rules.judge(documents(spark)).collect()}
    assert len(quality_rules.judge(documents(spark)).collect()) == len(REPEATED)
    for key, text, *_ in REPEATED:
        text, row = text or "", rows[key]
        words = [w for w in SPACE.split(text) if w]
        lines = [line for line in text.split("\n") if SPACE.sub("", line)]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == brute_repeats(words)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))
        assert not (row.kept and row.base_failed)


def test_divergence_bounds_and_guards(spark):
    assert quality_rules.divergence(np.array([1.0, 0]), np.array([2.0, 0])) == 0
    assert quality_rules.divergence(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1)
    plain = [(i, " ".join(f"the cat{i}x{j} and dog" for j in range(40)), "en", "s") for i in range(30)]
    odd = (99, " ".join("ABCDE%d!!" % j for j in range(120)), "en", "s")
    short = (98, "QQQ!! WWW!!", "en", "s")
    rows = {r.doc_id: r for r in quality_rules.judge(documents(spark, [*plain, odd, short]), quality_rules.Rules(min_words=1)).collect()}
    assert not rows[99].kept and rows[99].word_divergence > 0.45
    assert rows[98].kept and rows[98].char_divergence is None and rows[98].word_divergence is None
    assert rows[3].kept and rows[3].word_divergence < 0.3


def test_small_languages_are_judged(spark):
    """The verdict of a document does not depend on how much text other languages hold."""
    few = [(i, " ".join(f"the cat{i}x{j} and dog" for j in range(40)), "en", "s") for i in range(30)]
    few += [(99, " ".join("ABCDE%d!!" % j for j in range(120)), "en", "s"), (98, None, "en", "s"), (97, "", None, "s"), (96, "alone in its language " * 3, "zz", "s"), (95, " " * 300, "blank", "s")]
    many = [(1000 + i, " ".join(f"der{i % 7} hund{j}" for j in range(5000)), "de", "s") for i in range(60)]
    alone = {r.doc_id: r for r in quality_rules.judge(documents(spark, few), quality_rules.Rules(language_share=0)).collect()}
    within = {r.doc_id: r for r in quality_rules.judge(documents(spark, [*few, *many])).collect()}
    assert len(within) == len(few) + len(many)
    assert not within[99].kept and within[99].word_divergence > 0.45
    for key, one in alone.items():
        for name in one.asDict():
            assert within[key][name] == (pytest.approx(one[name]) if isinstance(one[name], float) else one[name])


def test_few_candidates_of_many_unlike_runs(spark, monkeypatch):
    """Words that are common in one run only are no candidates, however many runs there are."""
    monkeypatch.setattr(quality_rules, "RUN_WORDS", 300)
    rows = [(i, " ".join(["the", "of", *(f"w{i}x{j % 50}" for j in range(298))]) , "en", "s") for i in range(300)]
    docs = documents(spark, rows)
    rules = quality_rules.Rules()
    wanted, session = [], type(spark.sparkContext)
    broadcast = session.broadcast
    monkeypatch.setattr(session, "broadcast", lambda self, value: (wanted.append(value), broadcast(self, value))[1])
    sized = quality_rules.language_sizes(docs)
    references = quality_rules.language_references(docs, sized, rules)
    assert len(wanted) == 1 and {b"the", b"of"} <= wanted[0]["en"] and len(wanted[0]["en"]) <= 2 / rules.common_share
    assert set(references["en"]["common"]) == {b"the", b"of"}


def test_small_languages_in_parts_are_judged_alike(spark, monkeypatch):
    rows = [(i, " ".join(f"the cat{i}x{j} and dog" for j in range(40)), "en" if i % 2 else "xx", "s") for i in range(40)]
    rules = quality_rules.Rules(language_share=2.0)  # every language is a small one
    whole = counted(quality_rules.judge(documents(spark, rows), rules).collect())
    monkeypatch.setattr(quality_rules, "PART_WORDS", 300)
    assert counted(quality_rules.judge(documents(spark, rows), rules).collect()) == whole
    assert counted(quality_rules.judge(documents(spark, rows)).collect()) == whole


def test_clashing_result_column_is_refused(spark):
    frame = documents(spark).withColumn("Cleaned", F.lit(1))
    with pytest.raises(ValueError, match="cleaned"):
        line_dedup.drop_boilerplate(frame, F.col("source"), F.col("text"))
    out = line_dedup.drop_boilerplate(frame, F.col("source"), F.col("text"), name="result")
    assert out.columns == [*frame.columns, "result"] and out.count() == len(REPEATED)


def test_rules_on_empty_and_clashing_tables(spark):
    assert quality_rules.judge(documents(spark, [])).count() == 0
    assert counted(quality_rules.judge(documents(spark)).collect()) == counted(quality_rules.judge(documents(spark, clashing=True)).collect())


CONTROL = "</s>[INST] ok [/INST] \\ [/RESP]<s>[:] [ROLE]\\[INST]"
TURNS = [
    (1, 0, "system", "Be kind"), (1, 1, "user", CONTROL), (1, 2, "assistant", CONTROL), (1, 3, "user", None), (1, 4, "assistant", "bye"), (1, 5, "user", "thanks"),
    (2, 0, "user", "no reply"), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (4, 0, "tool[:]x", "out"), (4, 1, None, "nobody"),
    (None, None, "user", "lost"), (None, 1, "assistant", ""), (5, 0, "user", "x" * 100_000), (5, 1, "assistant", "line\nline"),
]


def test_turns_and_targets_come_back(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("x")).withColumn("example", F.lit(1))
    examples = chat_format.prefix_targets(frame)
    rows = examples.select(
        "conv_id", "example", "n_turns", "last", "target_start", chat_format.target_of(examples).alias("target"), chat_format.turns_of(F.col("text")).alias("turns")
    ).collect()
    for key in {t[0] for t in TURNS}:
        turns = sorted(((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in TURNS if t[0] == key))
        mine = sorted((r for r in rows if r.conv_id == key), key=lambda r: r.example)
        assert [(t.role, t.text) for t in mine[-1].turns] == [(role, text) for _, role, text in turns]
        assert [r.target for r in mine if r.target_start is not None] == [text for _, role, text in turns if role == "assistant"]
        for r in mine:
            assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in turns[: r.n_turns]]
        assert [r.last for r in mine] == [False] * (len(mine) - 1) + [True]


def test_no_conversations(spark):
    assert chat_format.prefix_targets(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def brute_lines(rows, ratio, least):
    pages, holding = {}, {}
    for _, text, _, host in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")}:
            holding[host, line] = holding.get((host, line), 0) + 1
    gone = {k for k, n in holding.items() if n >= least and n > ratio * pages[k[0]]}
    return [(key, None if text is None else "\n".join(x for x in text.split("\n") if (host, x) not in gone)) for key, text, _, host in rows]


def test_lines_equal_brute_force(spark):
    chance = random.Random(5)
    rows = [(i, "\n".join(chance.choice(["a", "b", "c", " ", "", f"own {i}"]) for _ in range(chance.randint(0, 6))), "en", chance.choice(["x", "x", "y", None])) for i in range(60)]
    rows += REPEATED
    for clashing in (False, True):
        frame = documents(spark, rows, clashing)
        out = line_dedup.drop_boilerplate(frame, frame["source"], frame["text"], ratio=0.3, min_pages=3)
        assert out.columns == [*frame.columns, "cleaned"]
        assert counted((r.doc_id, r.cleaned.text) for r in out.collect()) == counted(brute_lines(rows, 0.3, 3))


def test_copies_stay_whole(spark):
    rows = [(i, "one line\nand another", "en", "x") for i in range(5)]
    frame = documents(spark, rows)
    out = line_dedup.drop_boilerplate(frame, frame["source"], frame["text"], copies_once=True).collect()
    assert {r.cleaned.text for r in out} == {"one line\nand another"}
    assert line_dedup.drop_boilerplate(documents(spark, []), F.col("source"), F.col("text")).count() == 0


def test_lines_are_visible_by_their_first_character(spark, capsys):
    """No line is rewritten to see whether it has a visible character, and lines are made distinct as texts, not as pairs of hashes."""
    lines = ["", " ", "\t\r\x0b\x0c ", "\xa0", " \t x", "x ", "\x1c", "\u2003", "\r\x00", "é\t"]
    frame = spark.createDataFrame([(line,) for line in [*lines, None]], "line string").select("line", line_dedup._has_word(F.col("line")).alias("seen"))
    assert [r.seen for r in frame.collect()] == [bool(line.strip(" \t\r\x0b\x0c")) for line in lines] + [None]
    rows = [(i, "\n".join([*lines, "x ", f"own {i}"]), "en", "x") for i in range(4)]
    pages = documents(spark, rows)
    out = line_dedup.drop_boilerplate(pages, pages["source"], pages["text"])
    assert counted((r.doc_id, r.cleaned.text) for r in out.collect()) == counted(brute_lines(rows, line_dedup.RATIO, line_dedup.MIN_PAGES))
    assert {(r.cleaned.n_lines, r.cleaned.n_dropped) for r in out.collect()} == {(9, 8)}
    out.explain()
    assert "translate" not in capsys.readouterr().out


def test_page_of_many_lines(spark):
    """The distinct lines of a page take time in proportion to the lines; comparing all pairs of 200,000 would take minutes."""
    many = [f"line {i}" for i in range(200_000)]
    rows = [(1, "\n".join([*many, "all", "all"]), "en", "x"), (2, "all", "en", "x"), (3, "all", "en", "x")]
    frame = documents(spark, rows)
    began = time.monotonic()
    out = line_dedup.drop_boilerplate(frame, frame["source"], frame["text"]).collect()
    assert {r.doc_id: r.cleaned.n_dropped for r in out} == {1: 2, 2: 1, 3: 1}
    assert next(r for r in out if r.doc_id == 1).cleaned.text == "\n".join(many)
    assert time.monotonic() - began < 60


def test_hosts_and_visible_text(spark):
    frame = spark.createDataFrame([("HTTPS://u@Www.A.org:8/x?y", "<p>a<b>b</b><!-- <p>c --><script>var t='</p>';</script><li>d</li> \n e"), ("none", None), (None, "")], "url string, html string")
    rows = frame.select(line_dedup.host_of(F.col("url")), line_dedup.visible_text(F.col("html"))).collect()
    assert [tuple(r) for r in rows] == [("www.a.org", "\nab\nd\ne"), ("", None), (None, "")]


def brute_runs(pieces, least):
    """All pairs of sentences between which the first has just enough words, and the last run of the text."""
    words = [len([w for w in SPACE.split(p) if w]) for p in pieces]
    runs = set()
    for i in range(len(pieces)):
        for j in range(i, len(pieces)):
            if sum(words[i : j + 1]) >= least:
                runs.add((i, j))
                break
    return runs | ({(max(i for i, _ in runs), len(pieces) - 1)} if runs else set())


def brute_spans(rows, least):
    """Every row is a document; the first place of a run is that of the smallest id, none ahead, then of the first row."""
    texts = [re.findall(span_dedup.SENTENCE, row[1] or "") for row in rows]
    order = [(row[0] is not None, row[0] or 0, i) for i, row in enumerate(rows)]
    places = {}
    for row, pieces in enumerate(texts):
        for i, j in brute_runs(pieces, least):
            places.setdefault(tuple(p.strip(" \t\n\r\x0b\x0c") for p in pieces[i : j + 1]), []).append((order[row], row, i, j))
    gone = set()
    for found in places.values():
        first = min((place, i) for place, _, i, _ in found)
        gone |= {(row, s) for place, row, i, j in found if (place, i) != first for s in range(i, j + 1)}
    return [(row[0], None if row[1] is None else "".join(p for j, p in enumerate(texts[n]) if (n, j) not in gone)) for n, row in enumerate(rows)]


def test_unlike_rows_of_one_id_are_documents_of_their_own(spark):
    """A text found nowhere else stays, whatever id it shares."""
    alone = "nothing like this stands anywhere else in the table. It has words of its own, many more than the twenty that a run of sentences needs here, so it counts."
    for key in (5, None):
        rows = [(1, PASSAGE, "en", "x"), (key, PASSAGE, "en", "x"), (key, alone, "en", "x"), (key, PASSAGE, "en", "x")]
        got = span_dedup.drop_repeated_spans(documents(spark, rows).coalesce(1)).collect()
        assert counted((r.doc_id, r.text) for r in got) == counted(brute_spans(rows, span_dedup.MIN_WORDS))
        assert alone in {r.text for r in got} and sum(r.text == PASSAGE for r in got) == 1 and len(got) == 4


def test_any_bitmap_and_any_broadcast_give_the_same(spark, monkeypatch):
    rows = counted((r.doc_id, r.text) for r in span_dedup.drop_repeated_spans(documents(spark), min_words=4).collect())
    monkeypatch.setattr(span_dedup, "FILTER_BITS", 6)
    monkeypatch.setattr(span_dedup, "HELD_BYTES", 0)
    assert counted((r.doc_id, r.text) for r in span_dedup.drop_repeated_spans(documents(spark), min_words=4).collect()) == rows


def test_overlapping_runs_are_not_spelled_out(spark):
    """Their sentences are put together per row; a row of its own for each would grow with the runs times their length."""
    sentences = [f"w{i}a w{i}b." for i in range(12)]
    rows = [(0, 1, " ".join(sentences)), (1, 2, "x y z. " + " ".join(sentences[2:9]))]
    gone = span_dedup.repeated_sentences(spark.createDataFrame(rows, "row long, key long, text string"), min_words=4)
    assert {r["row"]: r["gone"] for r in gone.collect()} == {1: [1, 2, 3, 4, 5, 6, 7]}
    assert "Generate" not in gone._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("clashing", [False, True])
def test_spans_equal_brute_force(spark, clashing):
    chance = random.Random(2)
    rows = [(100 + i, " ".join(chance.choice(["a b, ", "c d e. ", "f\n", "g h; ", "."]) for _ in range(chance.randint(0, 12))), "en", "x") for i in range(40)]
    rows += REPEATED
    out = span_dedup.drop_repeated_spans(documents(spark, rows, clashing), min_words=4)
    assert counted((r.doc_id, r.text) for r in out.collect()) == counted(brute_spans(rows, 4))


def test_repeated_passages_go(spark):
    rows = {r.doc_id: r for r in span_dedup.drop_repeated_spans(documents(spark)).collect()}
    assert PASSAGE.split(", ")[0] in rows[8].text and "kappa lambda" not in rows[9].text and "twelve thirteen" not in rows[9].text
    assert span_dedup.drop_repeated_spans(documents(spark, [])).count() == 0


def test_scores(spark, tables):
    read = lambda name: spark.read.parquet(f"{tables}/{name}.parquet")
    forest = quality_model.train(read("documents"), read("labels"))
    scored = quality_model.score(read("documents"), forest).join(read("labels"), "doc_id").where("held_out").collect()
    assert len(scored) > 10
    assert sum(r.predicted == r.quality for r in scored) >= 0.95 * len(scored)
    odd = quality_model.score(documents(spark, clashing=True), forest).collect()
    assert len(odd) == len(REPEATED) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    kept = quality_model.keep_good(documents(spark, clashing=True), forest)
    assert kept.columns == documents(spark, clashing=True).columns
    assert kept.count() == sum(r.predicted for r in odd)
    for row in odd:
        import zlib

        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_splits_equal_exhaustive_search():
    """One tree of two levels: every split is the best of all features and places, by the gain of the logistic loss."""
    chance = np.random.default_rng(3)
    rows = np.round(chance.normal(size=(60, 4)), 1)
    labels = ((rows[:, 1] > 0.2) ^ (chance.random(60) < 0.2)).astype(float)
    settings = quality_model.Settings(trees=1, depth=2, bins=64, min_rows=5)
    forest = quality_model.fit(rows, labels, settings)
    share = labels.mean()
    slope, bend = share - labels, np.full(60, share * (1 - share))

    def value(inside):
        return slope[inside].sum() ** 2 / (bend[inside].sum() + settings.smoothing)

    def best(inside):
        gains = [
            value(inside & (rows[:, j] <= edge)) + value(inside & (rows[:, j] > edge)) - value(inside)
            for j in range(4) for edge in np.unique(rows[inside, j])
            if min((inside & (rows[:, j] <= edge)).sum(), (inside & (rows[:, j] > edge)).sum()) >= settings.min_rows
        ]
        return max(gains, default=0)

    for node, inside in ((0, np.ones(60, bool)), (1, rows[:, forest.feature[0, 0]] <= forest.threshold[0, 0]), (2, rows[:, forest.feature[0, 0]] > forest.threshold[0, 0])):
        left = inside & (rows[:, forest.feature[0, node]] <= forest.threshold[0, node])
        right = inside & ~left
        if np.isfinite(forest.threshold[0, node]):
            assert value(left) + value(right) - value(inside) == pytest.approx(best(inside), rel=0.05)


def test_trees_as_arrays_equal_walking():
    chance = np.random.default_rng(0)
    rows = chance.normal(size=(400, len(quality_model.STATISTICS)))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.3)).astype(float)
    forest = quality_model.fit(rows, labels, quality_model.Settings(trees=20, depth=3))
    for row, score in zip(rows[:50], forest.scores(rows[:50]), strict=True):
        margin = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            margin += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))
    assert ((forest.scores(rows) >= 0.5) == labels).mean() > 0.95


def test_training_without_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in quality_model.score(documents(spark), quality_model.train(documents(spark), labels)).collect()} == {0.5}
    assert quality_model.score(documents(spark, []), quality_model.train(documents(spark, []), labels.limit(0))).count() == 0


def test_license_headers(spark):
    rows = [*REPEATED, *((200 + i, f"Some words.\n{text}\nOther words here", "en", "x") for i, (_, text) in enumerate(license_scan.TEMPLATES))]
    found = {r.doc_id: r for r in license_scan.headers(documents(spark, rows, clashing=True)).collect()}
    assert found[13].license == "MIT" and found[13].last_line
    assert [found[200 + i].license for i in range(len(license_scan.TEMPLATES))] == [name for name, _ in license_scan.TEMPLATES]
    assert all(found[i].license is None for i in (1, 3, 4, 5, 6, None))
    assert license_scan.headers(documents(spark, [])).count() == 0


def test_early_exit_equals_full_cosine():
    matcher = license_scan.Matcher(1000, {b"the": 400, b"license": 20, b"under": 90})
    lazy = license_scan.Matcher(1000, {b"the": 400, b"license": 20, b"under": 90})
    chance = random.Random(1)
    terms = sorted(matcher.weights) + [b"x%d" % i for i in range(40)]
    matcher.threshold = 1e-12
    for _ in range(3000):
        line = b" ".join(chance.choices(terms, k=chance.randint(1, 14)))
        full = matcher.best(line)
        assert lazy.best(line) == (full if full and full[0] >= license_scan.THRESHOLD else None)


def test_inheritance(spark):
    files = [
        (1, "LICENSE", "MIT", 1.0), (2, "a/COPYING", "GPL-3.0", 0.9), (3, "a/LICENSE.txt", "Apache-2.0", 0.95), (4, "a/b/c/x.py", None, None),
        (5, "b/x.py", None, None), (6, "a/y.py", "BSD-3-Clause", 0.9), (7, None, None, None), (8, "top.py", None, None), (9, "ab/x", None, None),
    ]
    frame = spark.createDataFrame(files, "id long, path string, license string, cosine double").withColumn("origin_", F.lit(1))
    got = {r.id: (r.effective_license, r.origin) for r in license_scan.inherit(frame, F.col("path")).collect()}
    assert got[4] == ("Apache-2.0", "inherited") and got[5] == ("MIT", "inherited") and got[6] == ("BSD-3-Clause", "own")
    assert got[7] == (None, None) and got[8] == ("MIT", "inherited") and got[9] == ("MIT", "inherited") and got[2] == ("GPL-3.0", "own")
    assert license_scan.inherit(frame.limit(0), F.col("path")).count() == 0
