"""Word and token queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.operators import text
from seriesloom.plans.registry import query
from seriesloom.plans.views import TOKEN_USERS_SQL, WORDS_SQL, messages, r6, table, token_sql, user_groups
from seriesloom.sources.readers import spread

MIN_USERS = 20


def _messages(spark, folder):
    return spread(messages(spark, folder))


def _counts(spark, folder):
    return text.word_counts(spread(table(spark, folder, "documents").select("text")))


@query("word_count", f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY 1")
def word_count(spark, folder):
    return _counts(spark, folder)


@query("top_words", f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, word LIMIT 5")
def top_words(spark, folder):
    return text.most_common(_counts(spark, folder), "word", "n", 5)


@query(
    "corpus_stats",
    f"""WITH {WORDS_SQL} SELECT count(*) AS distinct_words, sum(n)::BIGINT AS total_words, round(avg(n), 6) + 0.0 AS mean_occurrences
        FROM (SELECT word, count(*) AS n FROM words GROUP BY 1)""",
)
def corpus_stats(spark, folder):
    stats = text.corpus_stats(_counts(spark, folder))
    return stats.withColumn("mean_occurrences", r6(F.col("mean_occurrences")))


@query(
    "tokenize",
    f"SELECT token, count(*) AS n FROM ({token_sql('documents', 'doc_id')}) GROUP BY 1",
)
def tokenize(spark, folder):
    return text.token_counts(_messages(spark, folder))


@query(
    "posts_per_group",
    "SELECT coalesce(quality, 7) AS group_id, count(*) AS posts FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
def posts_per_group(spark, folder):
    return text.posts_per_group(messages(spark, folder), user_groups(spark, folder))


_MENTIONS_SQL = f"WITH {TOKEN_USERS_SQL}, mentions AS (SELECT token, count(*) AS users FROM token_users GROUP BY 1)"


@query("token_mentions", f"{_MENTIONS_SQL} SELECT * FROM mentions")
def token_mentions(spark, folder):
    return text.token_mentions(_messages(spark, folder))


@query("token_count", f"{_MENTIONS_SQL} SELECT count(*) AS tokens FROM mentions")
def token_count(spark, folder):
    return text.token_mentions(_messages(spark, folder)).agg(F.count(F.lit(1)).alias("tokens"))


@query("token_support", f"{_MENTIONS_SQL} SELECT * FROM mentions WHERE users >= {MIN_USERS}")
def token_support(spark, folder):
    return text.token_mentions(_messages(spark, folder)).where(F.col("users") >= MIN_USERS)


@query("top_tokens", f"{_MENTIONS_SQL} SELECT * FROM mentions ORDER BY users DESC, token LIMIT 20")
def top_tokens(spark, folder):
    return text.most_common(text.token_mentions(_messages(spark, folder)), "token", "users", 20)


@query(
    "conversation_mentions",
    f"SELECT token, count(DISTINCT conv_id) AS users FROM ({token_sql('conversations', 'conv_id')}) GROUP BY 1",
)
def conversation_mentions(spark, folder):
    # Several texts per user: a user who repeats a token counts once.
    turns = table(spark, folder, "conversations").select(F.col("conv_id").alias("user_id"), "text")
    return text.token_mentions(spread(turns))


@query(
    "token_group_mentions",
    f"WITH {TOKEN_USERS_SQL} SELECT token, group_id, count(*) AS users FROM token_users GROUP BY 1, 2",
)
def token_group_mentions(spark, folder):
    return text.token_group_mentions(_messages(spark, folder), user_groups(spark, folder))


@query(
    "rel_popularity",
    f"""WITH {TOKEN_USERS_SQL}, g AS (SELECT token, group_id, count(*) AS users FROM token_users GROUP BY 1, 2),
        a AS (SELECT token, count(*) AS users FROM token_users GROUP BY 1 HAVING count(*) >= {MIN_USERS}),
        p AS (SELECT group_id, token, log2(g.users / a.users) AS popularity FROM g JOIN a USING (token)),
        r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY popularity DESC, token) AS rank FROM p)
        SELECT group_id, token, round(popularity, 6) + 0.0 AS popularity, rank::INTEGER AS rank FROM r WHERE rank <= 10""",
)
def rel_popularity(spark, folder):
    tops = text.relative_popularity(_messages(spark, folder), user_groups(spark, folder), min_users=MIN_USERS)
    return tops.withColumn("popularity", r6(F.col("popularity")))
