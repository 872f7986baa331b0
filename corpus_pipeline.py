"""From raw documents to packed sequences: five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, line_dedup, ngram_join, packing, quality_model
from seriesloom.llm.queries import WORD_BPE
from seriesloom.staging import stage


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000  # rows carry whole texts, so batches of the usual size would hold tens of MB per task


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _small_batches(spark: SparkSession) -> None:
    """Python workers get at most ``BATCH_ROWS`` rows at once, for the rest of the session, as stages are run by the caller."""
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    _small_batches(spark)
    return quality_model.keep_good(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that their source repeats; n_chars follows.

    Copies of a text count once per source, so they stay whole for the next stage.
    """
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), F.col("text"), copies_once=True)
    text = F.col("cleaned.text")
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return cleaned.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar ones: five-word shingles, a similarity of 0.8."""
    _small_batches(spark)
    return ngram_join.keep_one(docs, width=5, percent=80)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents that are left."""
    _small_batches(spark)
    return packing.pack(docs, WORD_BPE)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("contamination", contamination), ("pack", pack)]
ORACLE_SQL = None  # boosted trees, components and a tokenizer; tested stage by stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
