import random
import sys
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from cases import DOCUMENTS, REPEATED, documents  # noqa: E402

from seriesloom.llm import packing, token_counts  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def greedy(symbols, pieces, longest):
    """Longest match by trying every length; None if there is none."""
    at = found = 0
    while at < len(symbols):
        for end in range(min(len(symbols), at + longest), at, -1):
            if tuple(symbols[at:end]) in pieces:
                at, found = end, found + 1
                break
        else:
            return 1
    return found


def test_longest_match_on_random_vocabularies():
    for seed in range(60):
        chance = random.Random(seed)
        pieces = {tuple(chance.choices(range(3), k=chance.randint(1, 5))) for _ in range(chance.randint(1, 12))}
        matcher = token_counts.LongestMatch(sorted(pieces))
        for _ in range(60):
            word = chance.choices(range(3), k=chance.randint(1, 14))
            assert matcher.count(word) == greedy(word, pieces, 5), (seed, word)


def test_counts_equal_brute_force(spark):
    pieces = set(token_counts.pieces_of(token_counts.read_vocabulary(VOCABULARY)))
    longest = max(map(len, pieces))
    import re

    frame = documents(spark)
    got = sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in token_counts.count_tokens(frame, VOCABULARY).collect())
    expected = []
    for key, text, *_ in REPEATED:
        words = re.findall(token_counts.WORDS, (text or "").lower())
        expected.append((key or -1, len(words), sum(greedy((*w.encode(), 256), pieces, longest) for w in words)))
    assert got == sorted(expected)


def test_count_of_empty_and_clashing_tables(spark):
    assert token_counts.count_tokens(documents(spark, []), VOCABULARY).count() == 0
    plain = token_counts.count_tokens(documents(spark), VOCABULARY).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, token_counts.count_tokens(documents(spark, clashing=True), VOCABULARY).collect()))


def test_ids_equal_the_tokenizer(tables):
    import pyarrow.parquet as pq

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    ids = packing.TokenIds(token_counts.read_vocabulary(VOCABULARY))
    texts = pq.read_table(f"{tables}/documents.parquet")["text"].to_pylist()
    for text in [*texts, *(t for _, t, *_ in DOCUMENTS if t), "x\x1cy\x1fz \x85 a​b <|endoftext|> é ΑΣ", "A\x7fB"]:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_exact_ids_equal_the_default_tokenizer(spark, tables):
    import pyarrow.parquet as pq

    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = packing.TokenIds(token_counts.read_vocabulary(VOCABULARY), exact=True)
    texts = ["hello <|endoftext|> world", "A<|startoftext|>B<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "x\x1cy\x1fz \x85 a\u200bb é e\u0301 ΑΣ \u0130", "a \u0301b\u2000c\u1680d\u180ee\ufefff"]
    assert np.frombuffer(ids.of(texts[0]), "<u4").tolist() == [3306, 49407, 1002]
    every = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    texts += ["".join(f"a{c}B {c} " for c in every[i : i + 512]) for i in range(0, len(every), 512)]
    texts += ["e".join(every[i : i + 512]) for i in range(0, len(every), 512)]
    texts += pq.read_table(f"{tables}/documents.parquet")["text"].to_pylist() + [t for _, t, *_ in DOCUMENTS if t]
    for text in texts:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    rows = packing.pack(documents(spark, [(1, texts[0], "en", "x")]), VOCABULARY).collect()
    assert [(r.length, r.ids_crc32) for r in rows] == [(4, zlib.crc32(np.array([3306, 49407, 1002, 1], dtype="<u4").tobytes()))]


def test_ids_of_every_single_code_point():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = packing.TokenIds(token_counts.read_vocabulary(VOCABULARY), exact=True)
    every = [chr(i) for i in range(0x3400) if not 0xD800 <= i < 0xE000]
    texts = [shape.format(c) for c in every for shape in ("{}", "a{}", "{}b1", "é{}ö")]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids.of(text), "<u4").tolist() == found.ids, repr(text)


@pytest.mark.parametrize("group", [3, 40_000])
def test_pieces_are_whole_and_gapless(spark, group):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    capacity = 64
    rows = packing.pack(documents(spark), VOCABULARY, capacity=capacity, group_pieces=group).collect()
    expected = []
    for key, text, *_ in REPEATED:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start : start + capacity]
            expected.append((key or -1, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_is_close_to_the_bound():
    lengths = np.random.default_rng(1).integers(1, 4096, 20_000)
    sequence, offset, gap = packing.sum_of_squares(lengths, 4096)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 4096 and (4096 - used[sequence] == gap).all()
    assert len(used) <= 1.01 * max(lengths.sum() / 4096, (lengths > 2048).sum())


def test_packing_moves_to_the_smallest_sum_of_squares():
    """Every placement is a best one among open sequences, by trying all."""
    chance, capacity = random.Random(3), 20
    lengths = np.array(sorted((chance.randint(1, 19) for _ in range(60)), reverse=True))
    sequence, offset, _ = packing.sum_of_squares(lengths, capacity)
    gaps = {}
    for size, chosen in zip(lengths.tolist(), sequence.tolist()):
        def total(changed):
            counts = np.bincount([g for g in changed.values() if g], minlength=capacity + 1)
            return int((counts**2).sum())

        options = {b: total(gaps | {b: g - size}) for b, g in gaps.items() if g >= size}
        if chosen in gaps:
            assert options[chosen] == min(options.values())
        else:
            assert not options
        gaps[chosen] = gaps.get(chosen, capacity) - size


def test_packing_nothing(spark):
    assert packing.pack(documents(spark, []), VOCABULARY).count() == 0
    assert packing.pack(documents(spark, clashing=True), VOCABULARY).count() == len(packing.pack(documents(spark), VOCABULARY).collect())


def test_frequent_strings_stay_remembered(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 8)
    seen = []
    known = packing.Remembered(lambda w: (seen.append(w), w.encode())[1])
    for i in range(30):
        assert known["often"] == b"often" and known[f"w{i}"] == f"w{i}".encode()
        assert len(known) + len(known.old) <= 8
    assert seen.count("often") == 1


@pytest.mark.parametrize("chunk", ["word", "word,", "straße!", "don't", "it's.", "'s", "a1", "…", ".", "x.y", "über?", "ab!!"])
def test_chunks_of_letters_and_a_mark(chunk):
    vocabulary = token_counts.read_vocabulary(VOCABULARY)
    expected = Tokenizer.from_str(vocabulary.decode()).encode(chunk, add_special_tokens=False).ids
    assert np.frombuffer(packing.TokenIds(vocabulary, exact=True).of(chunk), "<u4").tolist() == expected


def test_ids_of_texts_side_by_side():
    """Each text has the tokenizer's ids, whatever its neighbours."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = packing.TokenIds(token_counts.read_vocabulary(VOCABULARY), exact=True)
    texts = ["", " \t\n", "One two, one\u00a0two\u2003THREE", "a\x1cb\x1fc \x85d", "x<|endoftext|> one", "two e\u0301 \u0130 \u3000", "\u1100\u1161 it's ''s 's !?.", "", "straße two,"]
    expected = [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(found, "<u4").tolist() for found in ids.of_all(texts)] == expected
    assert ids.of_all([]) == []


def test_lookups_follow_the_distinct_chunks():
    ids = packing.TokenIds(token_counts.read_vocabulary(VOCABULARY), exact=True)

    class Counted(dict):
        asked = 0

        def __getitem__(self, chunk):
            Counted.asked += 1
            return look_up[chunk]

    look_up, ids.chunk = ids.chunk, Counted()
    ids.of_all(["one two one two"] * 100)
    assert Counted.asked == 2
