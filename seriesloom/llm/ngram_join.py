"""Jaccard self-join of word n-gram sets, filtered under several global token orders.

Two sets with a similarity of at least t share a token among the first
n - ceil(t n) + 1 tokens of each under every global order, and the first one they share under an order leaves enough tokens
behind it in both.  The first order goes by the number of repetitions found in the corpus, rare tokens first; the
others are plain hashes, so they have little to do with the first or each other.  Candidates are sets
that share a token of their prefixes under the first order at places that allow the similarity.  The same must hold under two other
orders, and the counts of their tokens in bins must allow it; only then are they compared in full.

Equal sets are one node.  In a group of sets that share a token, all are first
compared with the one most of whose prefix is shared, which among near copies is the
original; then, twice, with the best one of another component.  After that, sets of different
components are still compared pair by pair, so a large group of near copies costs few comparisons
per member, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import fresh_name, mixed, polynomial, raw_texts, small_batches, small_side, text_slices
from seriesloom.llm.components import components
from seriesloom.staging import passing, stage

NGRAM = 5
PERCENT = 80
BLOCK_TOKENS = 1_000_000
REPEATED_TOKENS = 1_000_000
BIN_BITS = 9
STAR_ROUNDS = 3
CACHED_WORDS = 200_000
TABLE_BITS = 24
SLICE_BYTES = 1 << 20  # texts whose words are hashed together
_LONGS = T.ArrayType(T.LongType())


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def shingle_sets(texts: Sequence[bytes], width: int, known: dict) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of the runs of ``width`` lower-cased words; fewer words are one run.  All texts are hashed together."""
    words = [text.lower().split() for text in texts]
    ids = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=sum(map(len, words)))
    runs = polynomial(ids, width)  # also some that cross two texts
    out, at = [], 0
    for n in map(len, words):
        if n >= width:
            tokens = np.sort(runs[at : at + n - width + 1])
            fresh = np.ones(len(tokens), bool)
            np.not_equal(tokens[1:], tokens[:-1], out=fresh[1:])
            out.append(tokens[fresh])
        else:
            out.append(polynomial(ids[at : at + n], n) ^ np.uint64(n) if n else np.empty(0, np.uint64))
        at += n
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


@dataclass(frozen=True)
class Repeated:
    """Sorted tokens that are repeated in the corpus, and how often; all others count as not repeated."""

    tokens: np.ndarray
    counts: np.ndarray

    @cached_property
    def beginnings(self) -> np.ndarray:
        """Whether any token has these upper bits, so that most others need no search."""
        table = np.zeros(1 << TABLE_BITS, bool)
        table[self.tokens >> np.uint64(64 - TABLE_BITS)] = True
        return table

    def of(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(tokens), np.int64)
        likely = np.flatnonzero(self.beginnings[tokens >> np.uint64(64 - TABLE_BITS)])
        if len(likely):
            some = tokens[likely]
            at = np.minimum(np.searchsorted(self.tokens, some), len(self.tokens) - 1)
            out[likely] = np.where(self.tokens[at] == some, self.counts[at], 0)
        return out


def prefixes(tokens: np.ndarray, orders: Sequence[int], percent: int, repeated: Repeated) -> list[np.ndarray]:
    """The first tokens of a set under each of the orders."""
    return [prefix_sets([tokens], order, percent, repeated)[0] for order in orders]


def prefix_sets(sets: list[np.ndarray], order: int, percent: int, repeated: Repeated) -> list[np.ndarray]:
    """The first tokens of every set under one of the orders, in that order; order 1 puts rare tokens first, the others are hashes."""
    tokens = _flat(sets)
    keys = mixed(tokens, order)
    if order == 1:
        keys = np.minimum(repeated.of(tokens), 1023).astype(np.uint64) << np.uint64(54) | (keys >> np.uint64(10))
    out, at = [], 0
    for one in sets:
        if len(one):
            key, length = keys[at : at + len(one)], prefix_length(len(one), percent)
            first = np.argpartition(key, length - 1)[:length]
            out.append(one[first[np.argsort(key[first])]])
            at += len(one)
        else:
            out.append(one)
    return out


def _flat(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(sets) if sets else np.empty(0, np.uint64)


def binned(tokens: np.ndarray) -> bytes | None:
    """Tokens per bin, a byte each; None if a bin has more than fit.  The bins of two sets bound their intersection."""
    counts = np.bincount((mixed(tokens, 5) >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name every set, whatever the order of its tokens."""
    tokens = _flat(sets)
    ends = np.cumsum([0, *map(len, sets)])
    sums = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens, seed), dtype=np.uint64)]) for seed in (11, 12))
    return tuple((upto[ends[1:]] - upto[ends[:-1]]).view(np.int64) for upto in sums)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _repeated(documents: DataFrame, width: int) -> Repeated:
    """Tokens that are repeated inside blocks of documents, with their number in all such blocks together.

    Any such choice gives valid orders; it only has to hold the tokens of boilerplate and common passages.  Of more
    than ``REPEATED_TOKENS`` only those repeated more often are taken.
    """

    def repeated(block: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(block), return_counts=True)
        again = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(tokens[again].view(np.int64)), pa.array(counts[again].astype(np.int64))], names=["token", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block, seen, size = WordHashes(), [], set(), 0
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                for tokens in shingle_sets(raw_texts(part), width, known):
                    name = hash(tokens.tobytes())
                    if len(tokens) and name not in seen:
                        seen.add(name)
                        block.append(tokens)
                        size += len(tokens)
                if size > BLOCK_TOKENS:
                    yield repeated(block)
                    block, seen, size = [], set(), 0
        if block:
            yield repeated(block)

    counts = documents.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts, least = stage(counts, "repeated"), 2
    while counts.where(F.col("n") >= least).count() > REPEATED_TOKENS:
        least *= 2
    found = counts.where(F.col("n") >= least).toArrow()
    tokens, n = found.column("token").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(tokens)
    return Repeated(tokens[order], n[order])


def _signatures(documents: DataFrame, width: int, percent: int, repeated: Broadcast) -> DataFrame:
    """key, n, name_a, name_b and the prefix under the first order, per row of ``documents`` (key, text)."""
    schema = documents.select("key").schema
    for name in ("n", "name_a", "name_b"):
        schema = schema.add(name, "long")
    schema = schema.add("tokens", _LONGS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                sets = shingle_sets(raw_texts(part), width, known)
                first = [x.view(np.int64) for x in prefix_sets(sets, 1, percent, repeated.value)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([len(x) for x in sets], pa.int64()), *map(pa.array, _names(sets)), _lists(first, pa.int64())], names=schema.names
                )

    return documents.mapInArrow(sign, schema)


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = small_side(wanted.select(F.col("key").alias("same_key")).distinct())
    return documents.join(keys, F.col("key").eqNullSafe(F.col("same_key")), "left_semi").select("text")


class Measured:
    """Columns that are computed from the texts of nodes when they are first wanted, once per node."""

    def __init__(self, documents: DataFrame, named: DataFrame, columns: dict[str, T.DataType], width: int, measure: Callable[[list[np.ndarray]], list[pa.Array]]):
        self.documents, self.named, self.columns, self.width, self.measure = documents, named, columns, width, measure
        self.tables: list[DataFrame] = []

    def _computed(self, wanted: DataFrame) -> DataFrame:
        schema = wanted.select("name_a", "name_b").schema.add("n", "long")
        for name, kind in self.columns.items():
            schema = schema.add(name, kind)
        width, measure = self.width, self.measure

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = WordHashes()
            for batch in batches:
                for part in text_slices(batch, limit=SLICE_BYTES):
                    sets = [x for x in shingle_sets(raw_texts(part), width, known) if len(x)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, _names(sets)), pa.array([len(x) for x in sets], pa.int64()), *measure(sets)], names=schema.names)

        named = small_side(wanted.select("uid", "name_a", "name_b"))
        return _texts(self.documents, wanted).mapInArrow(build, schema).join(named, ["name_a", "name_b"]).drop("name_a", "name_b")

    def of(self, uids: DataFrame) -> DataFrame:
        """uid, n and the columns of these nodes at least; other nodes may be there too."""
        for table in self.tables:
            uids = uids.join(table.select("uid"), "uid", "left_anti")
        fresh = stage(uids, "wanted")
        if fresh.take(1) or not self.tables:
            wanted = stage(self.named.join(small_side(fresh), "uid"), "wanted")
            self.tables.append(stage(self._computed(wanted), "measured"))
        whole = self.tables[0]
        for table in self.tables[1:]:
            whole = whole.unionByName(table)
        return whole


def _filters(documents: DataFrame, named: DataFrame, width: int, percent: int, repeated: Broadcast) -> Measured:
    """Prefixes under the second and third order, and bins."""

    def measure(sets: list[np.ndarray]) -> list[pa.Array]:
        two = (prefix_sets(sets, order, percent, repeated.value) for order in (2, 3))
        return [*(_lists([x.view(np.int64) for x in one], pa.int64()) for one in two), pa.array([binned(x) for x in sets], pa.binary())]

    return Measured(documents, named, {"second": _LONGS, "third": _LONGS, "bins": T.BinaryType()}, width, measure)


def _sets(documents: DataFrame, named: DataFrame, width: int) -> Measured:
    """Whole sets."""
    return Measured(documents, named, {"whole": _LONGS}, width, lambda sets: [_lists([x.view(np.int64) for x in sets], pa.int64())])


def _close(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _bins_allow(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bins leave room for enough common tokens."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                counted = pc.and_(pc.is_valid(part.column("bins_a")), pc.is_valid(part.column("bins_b")))
                open_rows, part = part.filter(pc.invert(counted)), part.filter(counted)
                one, two = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, 1 << BIN_BITS) for c in ("bins_a", "bins_b"))
                common = np.minimum(one, two).sum(axis=1, dtype=np.int64)
                sizes = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
                for kept in (part.filter(pa.array(100 * common >= percent * (sizes - common))), open_rows):
                    yield kept.select(["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "bins_a", "bins_b").mapInArrow(bound, "a long, b long")


def _room(a_n: Column, a_pos: Column, b_n: Column, b_pos: Column, percent: int) -> Column:
    """Whether sets can be similar enough that share, as their first common token, those at these places of their prefixes."""
    most = F.least(a_n - a_pos, b_n - b_pos)
    return 100 * most >= percent * (a_n + b_n - most)


def _allowed(order: str, percent: int) -> Column:
    """Whether the prefixes of a and b under an order have a first common token, and at places that allow the similarity."""
    a, b = F.col(f"{order}_a"), F.col(f"{order}_b")
    first = F.get(F.array_intersect(a, b), F.lit(0))  # in the order of a
    place = lambda tokens: F.array_position(tokens, first) - 1
    return F.coalesce(_room(F.col("n_a"), place(a), F.col("n_b"), place(b), percent), F.lit(False))


def _links(pairs: DataFrame, filters: Measured, sets: Measured, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the other orders and the bins, and are similar enough."""

    def both(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
        return tuple(measured.select(F.col("uid").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in measured.columns if c != "uid")) for side in ("a", "b"))

    one, two = both(filters.of(_ends(pairs)))
    met = pairs.join(one, "a").join(two, "b").where(_close(F.col("n_a"), F.col("n_b"), percent))
    met = met.where(_allowed("second", percent)).where(_allowed("third", percent))
    left = stage(_bins_allow(met, percent).distinct(), "candidates")
    one, two = both(sets.of(_ends(left)))
    common = F.size(F.array_intersect("whole_a", "whole_b"))
    compared = left.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", common.alias("common"))
    return compared.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def similar_components(
    documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = NGRAM, percent: int = PERCENT
) -> DataFrame:
    """``key``, n_shingles and component_id (the smallest key of the component) for every row.

    Words are lower-cased (A to Z) runs of anything but ASCII white space.  Rows with equal sets, repeated ones too, are in one
    component.  Rows without words have n_shingles 0 and are their own component.  NULL keys take part, but never
    name a component that has another key; other columns are not read.
    """
    with passing() as keep, small_batches(documents.sparkSession):  # the tables of the search go when the components are known
        return keep(stage(_components_of(documents, key, text, width, percent), "similar"))


def _components_of(documents: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    repeated = documents.sparkSession.sparkContext.broadcast(_repeated(frame, width))  # at most REPEATED_TOKENS pairs of numbers
    signed = _signatures(frame, width, percent, repeated)
    rows = stage(signed.withColumn("uid", F.monotonically_increasing_id()), "signatures")
    nodes = stage(rows.where("n > 0").groupBy("name_a", "name_b").agg(F.min("uid").alias("node")), "nodes")
    own = rows.join(small_side(nodes.select(F.col("node").alias("uid"))), "uid", "left_semi")
    tokens = own.select("uid", "n", F.posexplode("tokens").alias("pos", "token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select("token")
    groups = stage(tokens.join(stage(shared, "shared"), "token"), "groups")
    named = own.select("uid", "key", "name_a", "name_b")
    filters, sets = _filters(frame, named, width, percent, repeated), _sets(frame, named, width)

    # A set of which most prefix tokens are shared stands in the middle of its copies: theirs have tokens of their own.
    weights = stage(groups.groupBy("uid").agg((F.count("*") / F.first("n")).alias("weight")), "weights")
    groups = stage(groups.join(weights, "uid"), "weighed")
    links, done = None, None
    for _ in range(STAR_ROUNDS):
        groups_now = groups if links is None else _open_groups(groups, roots)
        pairs = stage(_star(groups_now, percent), "pairs")
        if not pairs.take(1):
            break
        found = stage(_links(pairs, filters, sets, percent), "links")
        links, done = (found, pairs) if links is None else (links.unionByName(found), done.unionByName(pairs))
        roots = components(links)
    if links is None:  # every leader is of another size than its group; the pairs are left to the rest
        links = done = groups.select(F.col("uid").alias("a"), F.col("uid").alias("b")).limit(0)
        roots = components(links)
    rest = _rest(_open_groups(groups, roots), percent).join(done, ["a", "b"], "left_anti")
    pairs = stage(rest.join(done.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"), "pairs")
    if pairs.take(1):
        found = stage(_links(pairs, filters, sets, percent), "links")
        roots = components(links.unionByName(found)) if found.take(1) else roots

    named_roots = nodes.join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").select(
        "name_a", "name_b", F.coalesce("root", "node").alias("root")
    )
    placed = stage(rows.where("n > 0").select("key", "n", "name_a", "name_b").join(named_roots, ["name_a", "name_b"]).select("key", "n", "root"), "placed")
    smallest = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    out = placed.join(smallest, "root").select("key", "n", "component_id")
    empty = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return out.unionByName(empty).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct()


def _open_groups(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """Groups, with the component of every member, that still hold more than one component."""
    labelled = groups.drop("root").join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    several = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("token")
    return stage(labelled.join(several, "token", "left_semi"), "open")


def _star(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of the weightiest member of every group with all members of other components; of a later round, of the
    weightiest member outside the component that holds the weightiest of all."""
    own = lambda rows: F.struct("weight", (-F.col("uid")).alias("minus"), "n", "pos", *[c for c in rows.columns if c == "root"])
    best = lambda rows, name: rows.groupBy("token").agg(F.max(own(rows)).alias(name))
    if "root" not in groups.columns:
        leaders = best(groups, "leader")
        other = F.col("uid") != -F.col("leader.minus")
    else:
        first = best(groups, "first")
        outside = groups.join(first.select("token", F.col("first.root").alias("taken")), "token").where("root != taken").drop("taken")
        leaders = best(outside, "leader")
        other = F.col("root") != F.col("leader.root")
    near = groups.join(leaders, "token").where(other & _room(F.col("n"), F.col("pos"), F.col("leader.n"), F.col("leader.pos"), percent))
    return near.select((-F.col("leader.minus")).alias("a"), F.col("uid").alias("b")).distinct()


def _rest(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a token at places that allow the similarity, as the first one they share does."""
    a, b = (groups.select(*(F.col(c).alias(f"{side}_{c}") for c in ("token", "uid", "n", "pos", "root"))) for side in ("a", "b"))
    room = _room(F.col("a_n"), F.col("a_pos"), F.col("b_n"), F.col("b_pos"), percent)
    different = (F.col("a_uid") < F.col("b_uid")) & (F.col("a_root") != F.col("b_root")) & room
    return a.join(b, (F.col("a_token") == F.col("b_token")) & different).select(F.col("a_uid").alias("a"), F.col("b_uid").alias("b")).distinct()


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One row, with all its columns, of every component of similar rows: the one with the smallest key, NULLs last.

    Rows are told apart by a number of their own, so unlike rows that share a key, or have none, all stay.
    Rows without words are components of their own.
    """
    row = fresh_name(documents.columns, "row")
    numbered = stage(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = stage(similar_components(numbered, row, text, width, percent), "components").select(F.col(row).alias("one"), "component_id")
    keyed = found.join(numbered.select(F.col(row).alias("one"), F.col(key).alias("key")), "one")
    heads = keyed.groupBy("component_id").agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "one")).alias("head"))
    return numbered.join(small_side(stage(heads.select(F.col("head.one").alias(row)), "heads")), row, "left_semi").select(*[numbered[c] for c in documents.columns])
