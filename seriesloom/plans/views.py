"""Inputs that the queries derive from the tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.tokens import NAMED_ENTITY, TOKEN, URL

DAYS = 64  # length of the series that the vectors stand for
FAINT = 0.01  # smaller readings count as missing


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(column: Column) -> Column:
    return F.round(column, 6)


# ------------------------------------------------------------------- series


def series(spark: SparkSession, folder: str) -> DataFrame:
    reading = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) >= FAINT, x.cast("double")))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("station"),
        F.concat(F.lit("M"), F.col("label").cast("string")).alias("measurement"),
        (F.lit(1990) + F.col("vec_id") % 30).cast("int").alias("year"),
        reading.alias("values"),
    )


SERIES_LONG_SQL = f"""series_long AS (
  SELECT vec_id AS station, 'M' || label::VARCHAR AS measurement, (1990 + vec_id % 30)::INTEGER AS year,
         day::INTEGER AS day, CASE WHEN abs(embedding[day + 1]::DOUBLE) >= {FAINT} THEN embedding[day + 1]::DOUBLE END AS v
  FROM embeddings, range({DAYS}) AS g(day))"""


# ----------------------------------------------------------------- messages


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("user_id"), "text")


def user_groups(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(F.col("doc_id").alias("user_id"), F.col("quality").alias("group_id"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def token_sql(source: str, columns: str) -> str:
    """Rows of ``columns`` and the token, one per occurrence."""
    spelled = (
        f"CASE WHEN regexp_matches(replace(text, '&amp;', ' '), {quoted(NAMED_ENTITY)}) "
        "THEN replace(text, '&amp;', ' and ') ELSE text END"
    )
    return f"""SELECT {columns}, CASE WHEN regexp_matches(t, {quoted(URL)}) THEN t ELSE lower(t) END AS token
  FROM (SELECT *, unnest(regexp_extract_all({spelled}, {quoted(TOKEN)})) AS t FROM {source})"""


TOKEN_USERS_SQL = f"""token_users AS (
  SELECT DISTINCT user_id, group_id, token FROM (
  {token_sql("(SELECT d.doc_id AS user_id, coalesce(l.quality, 7) AS group_id, d.text FROM documents d LEFT JOIN labels l USING (doc_id))", "user_id, group_id")}))"""

WORDS_SQL = """words AS (
  SELECT doc_id, lang, word FROM (SELECT doc_id, lang, unnest(string_split_regex(text, '[ \\n]')) AS word FROM documents)
  WHERE word <> '')"""


# -------------------------------------------------------------- order values


def customer_years(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    cells = orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("station"))
    return cells.agg(F.avg("o_totalprice").alias("v"))


CUSTOMER_YEARS_SQL = """cells AS (
  SELECT year(o_orderdate)::INTEGER AS year, o_custkey AS station, avg(o_totalprice) AS v FROM orders GROUP BY ALL)"""


# -------------------------------------------------------------------- events


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    slot = (day * 24 + F.hour("ts")).cast("long").alias("slot")
    return table(spark, folder, "events").groupBy("event_type", slot).agg(F.avg("value").alias("v"))


HOURLY_SQL = """hourly AS (
  SELECT event_type, (date_diff('day', DATE '2024-01-01', ts::DATE) * 24 + hour(ts))::BIGINT AS slot, avg(value) AS v
  FROM events GROUP BY ALL)"""
