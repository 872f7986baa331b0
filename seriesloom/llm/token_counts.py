"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over byte symbols.  Every node has a failure link and
the number of pieces popped on the way to it, so one pass over a word counts its
greedy longest-match pieces without building them and without going back.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import text_slices

WORDS = r"[^\W\d_]+|\d|(?:[^\w\s]|_)+"
WORD_END = 256
FAILED = -1
CACHED_WORDS = 1_000_000
CACHED_LENGTH = 40
MAX_VOCABULARY = 64 << 20


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by a public rule:
    printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def pieces_of(vocabulary: bytes) -> list[tuple[int, ...]]:
    """Symbol strings of a byte-level vocabulary file with word-end marks; special tokens are left out."""
    model = json.loads(vocabulary)
    special = {token["content"] for token in model.get("added_tokens", [])}
    symbols, mark = byte_symbols(), model["model"].get("end_of_word_suffix") or ""
    pieces = []
    for piece in model["model"]["vocab"]:
        if piece in special:
            continue
        ends = bool(mark) and piece.endswith(mark)
        body = piece[: -len(mark)] if ends else piece
        pieces.append(tuple(symbols[c] for c in body) + ((WORD_END,) if ends else ()))
    return pieces


class LongestMatch:
    """Counts greedy longest-match pieces of one word in time linear in its length."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        edges: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                if symbol not in edges[node]:
                    edges[node][symbol] = len(edges)
                    edges.append({})
                    whole.append(False)
                node = edges[node][symbol]
            whole[node] = True
        link, popped = [FAILED] * len(edges), [0] * len(edges)
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for symbol, node in edges[parent].items():
                    deeper.append(node)
                    if whole[node]:
                        link[node], popped[node] = 0, 1
                        continue
                    at, count = link[parent], popped[parent]
                    while at != FAILED and symbol not in edges[at]:
                        count += popped[at]
                        at = link[at]
                    if at != FAILED:
                        link[node], popped[node] = edges[at][symbol], count
            level = deeper
        self.edges, self.link, self.popped = edges, link, popped

    def count(self, symbols) -> int:
        """Number of pieces; a word that cannot be split counts as one unknown piece."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for symbol in symbols:
            after = edges[node].get(symbol)
            while after is None:
                if link[node] == FAILED:
                    return 1
                total += popped[node]
                node = link[node]
                after = edges[node].get(symbol)
            node = after
        while node:
            if link[node] == FAILED:
                return 1
            total += popped[node]
            node = link[node]
        return total


class WordLengths(dict):
    """Pieces per word; short words are remembered up to a bound."""

    def __init__(self, matcher: LongestMatch):
        super().__init__()
        self.matcher = matcher

    def __missing__(self, word: str) -> int:
        count = self.matcher.count((*word.encode(), WORD_END))
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = count
        return count


@lru_cache(maxsize=2)
def word_lengths(vocabulary: bytes) -> WordLengths:
    """One automaton and one memory of words per Python worker."""
    return WordLengths(LongestMatch(pieces_of(vocabulary)))


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary files have at most {MAX_VOCABULARY} bytes")
    return data


def shipped(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast value, so that only the driver needs the file; its size is bounded."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def count_tokens(documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words and greedy word pieces of every text: ``key``, n_words, n_tokens.

    Texts are lower-cased; words are runs of letters, single digits and runs of other visible characters.
    One row per input row.  NULL and empty texts have no words and no tokens; repeated rows are counted each;
    NULL keys stay; other columns are not read.  A word of any length is one linear pass.
    """
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = documents.select(F.col(key).alias("key")).schema.add("n_words", "long").add("n_tokens", "long")
    source = shipped(documents.sparkSession, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, find = word_lengths(source.value), re.compile(WORDS).findall
        for batch in batches:
            for part in text_slices(batch):
                words, tokens = [], []
                for value in part.column("text").to_pylist():
                    found = find(value.lower()) if value else []
                    words.append(len(found))
                    tokens.append(sum(map(lengths.__getitem__, found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    names=["key", "n_words", "n_tokens"],
                )

    return frame.mapInArrow(count, schema).withColumnRenamed("key", key)
