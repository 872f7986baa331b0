"""Sum-of-squares packing of tokenised documents into sequences.

A document is placed where the sum over all gaps of the squared number of open
sequences with that gap becomes smallest.  The pieces are dealt by hash to groups of
bounded size; each group is packed longest piece first.  Sequences that a group leaves
with too large a gap are opened again and their pieces packed in the next, smaller
round, until one group of bounded size is left.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesloom.llm.common import text_slices
from seriesloom.llm.token_counts import byte_symbols, shipped
from seriesloom.staging import stage

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 40_000
CACHED_WORDS = 300_000
CACHED_LENGTH = 48
SLICE_BYTES = 1 << 20  # texts whose chunks are looked up together
# The characters that the tokenizer takes as white space, and its pattern of words.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
_ENDS = frozenset(".,;:!?")
_BY_WHITE = re.compile(f"[{WHITE}]+")
_WIDE = frozenset("\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000").union(map(chr, range(0x2000, 0x200B)))
_WIDE_WHITE = re.compile(f"[{''.join(sorted(_WIDE))}]")
_FIND_WORDS = regex.compile(WORDS).findall
_SYLLABLE_PARTS = {chr(c) for first, last in ((0x1100, 0x11FF), (0xA960, 0xA97F), (0xD7B0, 0xD7FF)) for c in range(first, last + 1)}
_BYTE_CHARACTERS = {byte: character for character, byte in byte_symbols().items()}


def plain(text: str) -> str:
    """Composed and lower-cased, a sigma by itself and not by its place."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


class Remembered(dict):
    """A function of strings that remembers the results of short ones, up to a bound.

    A full memory becomes the old one, from which results that are wanted again return, so frequent strings stay.
    """

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function, self.old = function, {}

    def __missing__(self, value: str) -> bytes:
        result = self.old.get(value)
        if result is None:
            result = self.function(value)
        if len(value) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS // 2:
                self.old = dict(self)
                self.clear()
            self[value] = result
        return result


class TokenIds:
    """Token ids of whole texts, as little-endian bytes.

    No word of the tokenizer's pattern holds white space, so a text is the chain of its chunks between
    white space; chunks and words are remembered, and only new words are merged by the tokenizer's model.
    With ``exact`` the ids are those of ``encode(text, add_special_tokens=False)``: in a text that holds an added token, or a character on which
    both ways were not seen to agree, the chunks with these go through the tokenizer.  Without, added tokens are ordinary text.
    """

    def __init__(self, vocabulary: bytes, exact: bool = False):
        tokenizer = Tokenizer.from_str(vocabulary.decode())
        merge = tokenizer.model.tokenize
        packed = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values(), default=0) + 1)]

        def merged(word: str) -> bytes:
            """Ids of a word; letters of ASCII stand for their own bytes."""
            spelled = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
            return b"".join([packed[t.id] for t in merge(spelled)])

        def chained(chunk: str) -> bytes:
            """Ids of the words; letters alone, or before one mark, need no search for them.  A word is a chunk of one word."""
            if chunk.isalpha():
                return merged(chunk)
            if chunk[-1:] in _ENDS and chunk[:-1].isalpha():
                return known[chunk[:-1]] + known[chunk[-1]]
            words = _FIND_WORDS(chunk)
            return merged(chunk) if words == [chunk] else b"".join([known[w] for w in words])

        self.chunk = known = Remembered(chained)
        self.exact = exact
        self.added = added = re.compile("|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()) or "(?!)").search

        def by_tokenizer(chunk: str) -> bytes:
            return np.array(tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

        def agrees(character: str) -> bool:
            """Whether a character beyond ASCII gives the same ids both ways, beside letters, digits and marks.

            Marks that combine, and the parts of Korean syllables, depend on what stands before them.
            """
            if unicodedata.category(character).startswith("M") or character in _SYLLABLE_PARTS:
                return False
            beside = [character, f"a{character}b", f"1{character}2", f"-{character}-", f"'{character}s", character + character]
            return all(by_tokenizer(text) == self.chunk[plain(text)] for text in beside)

        self.agreed = Remembered(agrees)

        def encoded(chunk: str) -> bytes:
            if added(chunk):
                return by_tokenizer(chunk)
            if chunk.isascii():
                return self.chunk[chunk.lower()]
            return self.chunk[plain(chunk)] if all(self.agreed[c] for c in set(chunk) if c > "\x7f") else by_tokenizer(chunk)

        self.whole = Remembered(encoded)

    def spaced(self, text: str) -> str | None:
        """The text as ``plain`` gives it, with no white space beyond ASCII; None if chunks of it may have to go through the tokenizer."""
        if self.exact and self.added(text):
            return None
        if text.isascii():
            return text.lower()
        characters = set(text)
        if self.exact and not all([self.agreed[c] for c in characters if c > "\x7f"]):
            return None
        return plain(text) if _WIDE.isdisjoint(characters) else _WIDE_WHITE.sub(" ", plain(text))

    def of(self, text: str) -> bytes:
        return self.of_all([text])[0]

    def of_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a chunk that several places hold is looked up once."""
        spaced = [self.spaced(text) for text in texts]
        # Arrow splits at the white space of ASCII, as the tokenizer does; Python would also split at \x1c to \x1f.
        parts = pc.ascii_split_whitespace(pa.array([text or "" for text in spaced], pa.large_string()))
        chunks = parts.flatten().dictionary_encode()
        found = list(map(self.chunk.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False).tolist()))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        which = chunks.indices.to_numpy()
        each = sizes[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = ids[np.repeat(first[which] - upto[:-1], each) + np.arange(upto[-1])]
        ends = upto[parts.offsets.to_numpy()]
        rows = zip(texts, spaced, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        return [self._mixed(text) if plainly is None else ids[at:to].tobytes() for text, plainly, at, to in rows]

    def _mixed(self, text: str) -> bytes:
        return b"".join(map(self.whole.__getitem__, filter(None, _BY_WHITE.split(text))))


@lru_cache(maxsize=1)
def token_ids(vocabulary: bytes) -> TokenIds:
    """One memory of words per Python worker."""
    return TokenIds(vocabulary, exact=True)


def tokenised(documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: key, piece, start, length, ids_crc32."""
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = frame.select("key").schema
    for name in ("piece", "start", "length", "ids_crc32"):
        schema = schema.add(name, "integer" if name == "piece" else "long")
    source = shipped(documents.sparkSession, vocabulary)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_all = token_ids(source.value).of_all
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                owner, pieces, starts, lengths, sums = [], [], [], [], []
                texts = [value or "" for value in part.column("text").to_pylist()]
                for row, text_ids in enumerate(ids_of_all(texts)):
                    ids = memoryview(text_ids + end)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at : at + 4 * capacity]
                        owner.append(row)
                        pieces.append(piece)
                        starts.append(at // 4)
                        lengths.append(len(cut) // 4)
                        sums.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(owner, pa.int64())), pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
                    names=schema.names,
                )

    return frame.mapInArrow(tokenise, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and final gap of its sequence for every piece, taken longest first.

    A move is weighed by half the change of the sum of squares; a full sequence is no longer open.
    Equal moves go to the smallest gap, and an open sequence is preferred to a new one.
    """
    open_with = np.zeros(capacity + 1, dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    sequence, offset, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for item in order:
        size = int(lengths[item])
        fit = np.flatnonzero(open_with[size:]) + size
        chosen = -1
        if len(fit):
            after = np.where(fit == size, -0.5, open_with[fit - size])
            chosen = int(fit[np.argmin(after - open_with[fit] + 1)])
        if chosen < 0:
            bin_id, gap = len(gaps), capacity
            gaps.append(gap)
        else:
            bin_id, gap = waiting[chosen].pop(), chosen
            open_with[chosen] -= 1
        sequence[item], offset[item] = bin_id, capacity - gap
        gaps[bin_id] = gap - size
        if gap > size:
            open_with[gap - size] += 1
            waiting[gap - size].append(bin_id)
    return sequence, offset, np.array(gaps, dtype=np.int64)[sequence] if len(lengths) else sequence


LOOSE_GAP = 64


def pack(
    documents: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Places of all pieces: ``key``, piece, start, length, ids_crc32, sequence_id, offset.

    A text is the ids of the vocabulary file, added tokens in it as their own ids, and the id 1; only a longer one is cut, into pieces of ``capacity``
    tokens.  NULL and empty texts are the id 1 alone; repeated rows and NULL keys are packed each; other columns
    are not read; an empty table gives no piece.  Groups of about ``group_pieces`` pieces are packed by one
    task each, so no task ever holds more than a few times that many numbers.
    """
    pieces = tokenised(documents, vocabulary, key, text, capacity)
    numbered = stage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = numbered.where(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed, left, level = [full], numbered.where(F.col("length") < capacity).select("uid", "length"), 0
    count = left.count()
    while count:
        groups = max(1, -(-count // group_pieces))
        packed = stage(_packed(left, groups, capacity, level), f"packed{level}")
        if groups == 1:
            placed.append(packed.select("uid", "sequence_id", "offset"))
            break
        loose = F.col("gap") > LOOSE_GAP
        placed.append(packed.where(~loose).select("uid", "sequence_id", "offset"))
        left = packed.where(loose).select("uid", "length")
        remaining, level = left.count(), level + 1
        if remaining > count // 2:  # the groups have filled too little to make fewer of them
            placed.append(packed.where(loose).select("uid", "sequence_id", "offset"))
            break
        count = remaining
    places = placed[0]
    for more in placed[1:]:
        places = places.unionByName(more)
    return numbered.join(places, "uid").drop("uid").withColumnRenamed("key", key)


def _packed(left: DataFrame, groups: int, capacity: int, level: int) -> DataFrame:
    """One round: uid, length, sequence_id, offset, gap.  A sequence has the number of its first piece."""

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        sequence, offset, gap = sum_of_squares(rows["length"].to_numpy(), capacity)
        first = np.full(int(sequence.max()) + 1, -1, dtype=np.int64)
        starts = offset == 0
        first[sequence[starts]] = rows["uid"].to_numpy()[starts]
        return pd.DataFrame({"uid": rows["uid"], "length": rows["length"], "sequence_id": first[sequence], "offset": offset, "gap": gap})

    dealt = left.withColumn("deal", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(groups)))
    return dealt.groupBy("deal").applyInPandas(lambda rows: place(rows), "uid long, length long, sequence_id long, offset long, gap long")
