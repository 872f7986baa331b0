"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds one posting (term, document, position) for every training token that
is a term of the given tests, each task's part in order of term, and one posting of an empty term per
document whose position is the document's number of words.  Documents are rows, whatever their keys; other tests
need an index of their own.  A search takes the rarest
terms of every test window, shifts their positions by their place in the item, and
intersects the lists: places of a document where at least two rare terms of an item stand at the right
distance are candidates, and only there are the postings of all other terms looked
up.  Runs of matching places that are long enough are exact phrase matches; with a slop,
runs of places matched within the slop are proximity matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.llm.common import fresh_name, small_side
from seriesloom.staging import stage

WINDOW = 10
RARE_TERMS = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters and digits and of characters beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


@dataclass(frozen=True)
class Tests:
    """Staged test tables: places (item, place, term) and vocabulary (term, word)."""

    places: DataFrame
    vocabulary: DataFrame


@dataclass(frozen=True)
class Index:
    """A staged table of postings (term, doc, pos, key); doc is the number of a row, term -1 has the number of words as pos and the row's key."""

    postings: DataFrame


def read_tests(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Tests:
    """Items are numbered by key and text, so repeated rows are one item and items of one key stay apart."""
    items = benchmark.select(F.col(key).alias("item_key"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    items = stage(items.withColumn("item", F.monotonically_increasing_id()), "items")
    exploded = items.select("item", "item_key", F.size("words").alias("n"), F.posexplode("words").alias("place", "word"))
    vocabulary = stage(exploded.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    return Tests(stage(exploded.join(vocabulary, "word").drop("word"), "places"), vocabulary)


def build_index(documents: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> Index:
    """Postings of all test terms in all documents.  One pass over the texts, no shuffle for a vocabulary of bounded size.

    Rows are numbered on the way, or have their number in the column ``row``.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = documents.select(number.alias("doc"), F.col(key).alias("key"), F.concat(words_of(F.col(text)), F.array(F.lit(""))).alias("words"))
    tokens = rows.select("doc", "key", F.posexplode("words").alias("pos", "word"))
    ends = F.lit(-1).cast("long")
    known = small_side(vocabulary.unionByName(vocabulary.sparkSession.range(1).select(F.lit("").alias("word"), ends.alias("term"))))
    postings = tokens.join(known, "word").select("term", "doc", "pos", F.when(F.col("term") < 0, F.col("key")).alias("key"))
    return Index(stage(postings.sortWithinPartitions("term"), "postings"))


def search(index: Index, tests: Tests, window: int = WINDOW, rare: int = RARE_TERMS, slop: int = 0) -> DataFrame:
    """Matches: item_key, doc, first, last (word positions), exact.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.  ``exact`` rows are runs
    of words equal to one or more overlapping windows; with ``slop`` > 0 the other rows are runs of places whose terms all
    stand at most ``slop`` words away from their place.
    """
    counts = index.postings.where("term >= 0").groupBy("term").agg(F.count("*").alias("postings"))
    counted = stage(tests.places.join(counts, "term", "left").fillna(0, ["postings"]), "counted")
    width = F.least("n", F.lit(window))
    starts = counted.select("item", "place", "term", "postings", width.alias("width"), F.explode(
        F.sequence(F.greatest(F.lit(0), F.col("place") - width + 1), F.least("place", F.col("n") - width))
    ).alias("start"))
    ordered = W.partitionBy("item", "start").orderBy("postings", "place")
    ranked = starts.withColumn("rank", F.row_number().over(ordered)).withColumn("least", F.first("postings").over(ordered))
    rarest = stage(
        ranked.where((F.col("rank") <= rare) & (F.col("least") > 0)).select("item", "place", "term", F.least("width", F.lit(rare)).alias("needed")).distinct(),
        "rarest",
    )
    drift = lambda c: F.explode(F.sequence(c - slop, c + slop)) if slop else c
    shifted = index.postings.join(small_side(rarest), "term").select("item", "doc", "place", "needed", drift(F.col("pos") - F.col("place")).alias("shift"))
    agreeing = shifted.groupBy("item", "doc", "shift").agg(F.countDistinct("place").alias("agree"), F.first("needed").alias("needed"))
    candidates = stage(agreeing.where("agree >= needed").select("item", "doc", "shift"), "candidates")
    docs = small_side(stage(candidates.select("doc").distinct(), "candidate_docs"))
    wanted = candidates.join(small_side(tests.places), "item").select(
        "item", "item_key", "n", "place", "term", F.col("doc").alias("in_doc"), "shift", drift(F.col("shift") + F.col("place")).alias("pos")
    )
    own = index.postings.join(docs.withColumnRenamed("doc", "in_doc"), F.col("doc") == F.col("in_doc"), "left_semi")
    here = (wanted["term"] == own["term"]) & (wanted["pos"] == own["pos"]) & (wanted["in_doc"] == own["doc"])
    found = wanted.join(own, here, "left_semi").select(
        "item", "item_key", "n", F.col("in_doc").alias("doc"), "shift", "place", (F.col("pos") == F.col("shift") + F.col("place")).alias("exact")
    )
    near = found.groupBy("item", "item_key", "n", "doc", "shift", "place").agg(F.max("exact").alias("exact"))

    def islands(rows: DataFrame, exact: bool) -> DataFrame:
        in_line = W.partitionBy("item", "doc", "shift").orderBy("place")
        runs = rows.withColumn("island", F.col("place") - F.row_number().over(in_line))
        spans = runs.groupBy("item", "item_key", "n", "doc", "shift", "island").agg(F.min("place").alias("a"), F.max("place").alias("b"))
        return spans.where(F.col("b") - F.col("a") + 1 >= width).select(
            "item_key", "doc", (F.col("shift") + F.col("a")).alias("first"), (F.col("shift") + F.col("b")).alias("last"), F.lit(exact).alias("exact")
        )

    exact = islands(near.where("exact"), True)
    return exact.unionByName(islands(near, False)) if slop else exact


def hits(index: Index, tests: Tests, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """in_doc, n_hit, items (names, sorted as strings) and n_near_items of the documents with a match."""
    matches = stage(search(index, tests, window, slop=slop), "matches")
    words = matches.where("exact").select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    counts = words.groupBy(F.col("doc").alias("hit_doc")).agg(F.count("*").alias("n_hit"))
    name = F.coalesce(F.col("item_key").cast("string"), F.lit(""))
    items = matches.groupBy("doc").agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), name))).alias("items"), F.countDistinct(name).alias("n_near_items")
    )
    joined = items.join(counts, F.col("hit_doc") == F.col("doc"), "left")
    return stage(joined.select(F.col("doc").alias("in_doc"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "items", "n_near_items"), "hits")


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int = 0,
) -> DataFrame:
    """``key``, n_words, n_hit, items (sorted as strings), n_items, n_near_items for every row.

    Every row is a document of its own, also rows that share a key or have none.  NULL and empty
    texts have no words and no hits; NULL item keys count as an empty name; items without words never
    occur; other columns are not read.  Empty tables give no rows, or rows without hits.
    """
    tests = read_tests(benchmark, item_key, item_text)
    index = build_index(documents, tests.vocabulary, key, text)
    found = hits(index, tests, window, slop)
    sizes = index.postings.where("term = -1").select("doc", "key", F.col("pos").cast("long").alias("n_words"))
    out = sizes.join(small_side(found), F.col("doc") == F.col("in_doc"), "left")
    return out.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("n_near_items", F.lit(0).cast("long")).alias("n_near_items"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``documents``, with all their columns, that hold no window of a benchmark item.

    Rows are told apart by a number of their own, so one that shares its key with a contaminated row stays.
    """
    row = fresh_name(documents.columns, "row")
    numbered = stage(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    tests = read_tests(benchmark, item_key, item_text)
    found = hits(build_index(numbered, tests.vocabulary, key, text, row), tests)
    gone = stage(found.where("n_hit > 0").select(F.col("in_doc").alias(row)), "gone")
    return numbered.join(small_side(gone), row, "left_anti").select(*[numbered[c] for c in documents.columns])
