"""Word and token statistics over large text collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions import tokens as tok
from seriesloom.operators.ordered import top_per_group

DEFAULT_GROUP = 7
MIN_USERS = 100
TOP_TOKENS = 10


def each(docs: DataFrame, pieces: Column, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of an expensive array.

    Spark filters empty arrays before a plain explode and computes the array
    twice for it; here the empty ones leave afterwards.
    """
    return docs.select(F.explode_outer(pieces).alias(name), *keep).where(F.col(name).isNotNull())


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over all texts."""
    words = each(docs, tok.words(F.col(text)), "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def most_common(counts: DataFrame, item: str, n: str, k: int) -> DataFrame:
    """The k most frequent items; ties by item."""
    return counts.orderBy(F.col(n).desc(), F.col(item)).limit(k)


def corpus_stats(counts: DataFrame, n: str = "n") -> DataFrame:
    """Distinct items, occurrences, and occurrences per item."""
    return counts.agg(
        F.count(F.lit(1)).alias("distinct_words"),
        F.sum(n).alias("total_words"),
        F.avg(n).alias("mean_occurrences"),
    )


def with_group(messages: DataFrame, lookup: DataFrame, default: int = DEFAULT_GROUP) -> DataFrame:
    """Add ``group_id`` of the message's user; users missing from the lookup get the default.

    The lookup has one row per user.  Whether it is broadcast is left to the
    planner's size threshold; beyond it, runs of one user are split by AQE.
    """
    joined = messages.join(lookup, "user_id", "left")
    return joined.withColumn("group_id", F.coalesce("group_id", F.lit(default)))


def posts_per_group(messages: DataFrame, lookup: DataFrame, default: int = DEFAULT_GROUP) -> DataFrame:
    """Messages per user group, in group order.  Counted per user before the join."""
    per_user = messages.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    grouped = with_group(per_user, lookup, default).groupBy("group_id").agg(F.sum("n").alias("posts"))
    return grouped.orderBy("group_id")


def token_users(messages: DataFrame) -> DataFrame:
    """Distinct ``token, user_id`` pairs."""
    return each(messages, F.array_distinct(tok.tokens(F.col("text"))), "token", ("user_id",)).distinct()


def token_counts(messages: DataFrame) -> DataFrame:
    """Number of occurrences of every token."""
    found = each(messages, tok.tokens(F.col("text")), "token")
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def token_mentions(messages: DataFrame) -> DataFrame:
    """Number of distinct users per token."""
    return token_users(messages).groupBy("token").agg(F.count(F.lit(1)).alias("users"))


def token_group_mentions(messages: DataFrame, lookup: DataFrame, default: int = DEFAULT_GROUP) -> DataFrame:
    """Distinct users per token and group.

    The lookup joins the distinct pairs: a busy user has no more of them than
    there are tokens, while the user's messages, joined first, would meet in one task.
    """
    pairs = with_group(token_users(messages), lookup, default)
    return pairs.groupBy("token", "group_id").agg(F.count(F.lit(1)).alias("users"))


def relative_popularity(
    messages: DataFrame,
    lookup: DataFrame,
    default: int = DEFAULT_GROUP,
    min_users: int = MIN_USERS,
    top: int = TOP_TOKENS,
) -> DataFrame:
    """Per group the tokens with the highest log2(users in the group / users overall).

    A user has one group, so the overall count is the sum over the groups: one
    row per group and token, added up without a second pass over the text.
    """
    by_group = token_group_mentions(messages, lookup, default)
    overall = F.sum("users").over(Window.partitionBy("token"))
    frequent = by_group.withColumn("all_users", overall).where(F.col("all_users") >= min_users)
    scored = frequent.select("group_id", "token", F.log2(F.col("users") / F.col("all_users")).alias("popularity"))
    return top_per_group(scored, ["group_id"], [F.col("popularity").desc(), F.col("token")], top)
