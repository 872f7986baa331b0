"""The registered queries against their SQL, and the pipeline stage by stage."""

import os
import sys

import pytest
from oracle import compare, connect

sys.path.insert(0, os.path.dirname(__file__))
from cases import REPEATED, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from seriesloom.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, tables, name):
    assert compare(spark, tables, connect(tables), QUERIES[name], ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_covers_all_documents(spark, tables, name):
    ids = {r.doc_id for r in QUERIES[name](spark, tables).select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id").collect()}


@pytest.fixture(scope="module")
def outputs(spark, tables):
    """What goes into each stage and what comes out."""
    from seriesloom.staging import stage

    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, tables), name)
        out[name] = docs, after
        docs = after
    return out


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_keep_the_columns(outputs):
    for name in list(outputs)[:-1]:
        before, after = outputs[name]
        assert before.schema.names == after.schema.names and 0 < after.count() <= before.count()


def test_quality_keeps_good_documents(spark, tables, outputs):
    before, after = outputs["quality"]
    labels = spark.read.parquet(f"{tables}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    kept = rows_of(after)
    marks = [(r.quality, r.doc_id in kept) for r in labels.collect()]
    assert sum((quality > 0) == stays for quality, stays in marks) >= 0.95 * len(marks)


def test_lines_equal_brute_force(spark, tables):
    """Lines are counted over the distinct texts of a source; copies of pages tell that apart from counting pages."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(60)
    common = "A line that three unlike pages of this source have"
    more = [(5000 + i, f"{common}\nand line {i}", "en", "made", 40) for i in range(3)]
    more += [(6000 + i, "One page of which there are copies\nwith two lines", "en", "made", 50) for i in range(9)] + [(7000 + i, f"other {i}\n", "en", "made", 8) for i in range(12)]
    frame = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long").select(*[F.col(f.name).cast(f.dataType) for f in docs.schema]))
    before, after = rows_of(frame), rows_of(corpus_pipeline.lines(spark, frame, tables))
    texts, holding = {}, {}
    for source, text in {(r.source, r.text) for r in before.values()}:
        texts[source] = texts.get(source, 0) + 1
        for line in {x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")}:
            holding[source, line] = holding.get((source, line), 0) + 1
    gone = {k for k, n in holding.items() if n >= 3 and n > 0.1 * texts[k[0]]}
    assert ("made", common) in gone and ("made", "with two lines") not in gone
    for key, r in before.items():
        kept = [x for x in r.text.split("\n") if (r.source, x) not in gone]
        assert after[key].text == "\n".join(kept) and after[key].n_chars == len(after[key].text)


def test_one_document_of_each_group(outputs):
    from test_matching import brute_similar

    before, after = (rows_of(x) for x in outputs["near_duplicates"])
    found = brute_similar([(r.doc_id, r.text) for r in before.values()], 5, 80)
    assert set(after) == {key for key, n, root in found if key == root or not n}
    assert all(after[key] == before[key] for key in after)


def test_contaminated_documents_go(spark, tables, outputs):
    from test_matching import brute_hits

    before, after = (rows_of(x) for x in outputs["contamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    hits = brute_hits([(r.doc_id, r.text) for r in before.values()], items, 10)
    assert set(after) == {key for key, (_, n, _) in hits.items() if not n}


def test_pieces_of_all_documents_left(outputs):
    before, after = outputs["pack"]
    assert {r.doc_id for r in before.collect()} == {r.doc_id for r in after.collect()}
    total, sequences = after.agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert sequences <= 1.05 * total / 4096 + 1


def test_stages_on_awkward_documents(spark, tables):
    docs = documents(spark).withColumn("n_chars", F.length("text").cast("long"))
    for frame in (docs, docs.limit(0)):
        empty = not frame.take(1)
        for name, function in corpus_pipeline.STAGES:
            frame = function(spark, frame, tables)
        assert not (empty and frame.take(1))
        assert frame.columns[0] == "doc_id"
        left = {r.doc_id for r in frame.collect()}
        assert left <= {row[0] for row in REPEATED} and (not left or frame.count() >= len(left))


def test_short_pages_lose_their_boilerplate(spark, tables):
    """A page that is mostly boilerplate loses it; copies of one text make no boilerplate."""
    common = "A line that stands on many of the pages of this source"
    rows = [(i, f"{common}\nown {i}", "en", "x") for i in range(6)] + [(10 + i, "One copied line\nand another", "en", "x") for i in range(4)]
    docs = documents(spark, [*rows, (20, common, "en", "y"), (21, None, "en", "x")]).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, docs, tables).collect()}
    assert [got[i] for i in range(6)] == [(f"own {i}", 5) for i in range(6)]
    assert {got[10 + i][0] for i in range(4)} == {"One copied line\nand another"}
    assert got[20][0] == common and got[21] == (None, None)


def test_licenses_of_repeated_and_missing_ids(spark, tmp_path):
    """One row per document, whatever its id."""
    docs = documents(spark).unionByName(documents(spark)).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_license_scan"](spark, str(tmp_path)).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in docs.groupBy("doc_id").count().collect()}
