"""Join and grouping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import tokens as tok
from seriesloom.operators.folding import central_moments, fold_by_key
from seriesloom.operators.ordered import chunked_lists
from seriesloom.operators.sets import skewed_outer_join
from seriesloom.operators.text import each, with_group
from seriesloom.plans.registry import query
from seriesloom.plans.views import WORDS_SQL, messages, table, user_groups
from seriesloom.sources.readers import spread
from seriesloom.staging import stage

# --------------------------------------------------------------------- joins
# No join carries a hint: Spark broadcasts a side below its size threshold and
# otherwise shuffles, with adaptive splitting of keys that hold many rows.  It cannot split
# a key on the optional side of an outer join; such joins are an inner join, which it can
# split, and the rows without a partner, for which one row per key is enough.


@query(
    "join_inner",
    """SELECT o_custkey AS k, o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(spark, folder):
    left = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    right = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey")
    return left.join(right, "k")


@query(
    "join_left",
    "SELECT c_custkey AS k, c_nationkey, event_id FROM customer LEFT JOIN events ON user_id = c_custkey",
)
def join_left(spark, folder):
    left = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey")
    right = table(spark, folder, "events").select(F.col("user_id").alias("k"), "event_id")
    return skewed_outer_join(left, right, "k", "left")


@query(
    "join_right",
    "SELECT d.doc_id AS k, toxic, lang FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id",
)
def join_right(spark, folder):
    left = table(spark, folder, "labels").select(F.col("doc_id").alias("k"), "toxic")
    right = table(spark, folder, "documents").select(F.col("doc_id").alias("k"), "lang")
    return left.join(right, "k", "right")


@query(
    "join_full",
    """SELECT coalesce(l.doc_id, e.vec_id) AS k, quality, label FROM labels l
       FULL JOIN embeddings e ON l.doc_id = e.vec_id""",
)
def join_full(spark, folder):
    left = table(spark, folder, "labels").select(F.col("doc_id").alias("k"), "quality")
    right = table(spark, folder, "embeddings").select(F.col("vec_id").alias("k"), "label")
    return skewed_outer_join(left, right, "k", "full")


@query("join_anti", "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_anti(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id")
    return table(spark, folder, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left_anti")


@query("cross_join", "SELECT c_custkey, r_regionkey FROM customer, region")
def cross_join(spark, folder):
    # The product is the operator itself; one side has five rows whatever the scale.
    customers = table(spark, folder, "customer").select("c_custkey")
    return customers.crossJoin(table(spark, folder, "region").select("r_regionkey"))


@query(
    "join_dimension",
    """SELECT o_orderkey, o_custkey, c_mktsegment, n_name, n_regionkey FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def join_dimension(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = orders.join(customer, "o_custkey", "left").join(nation, "c_nationkey", "left")
    return joined.select("o_orderkey", "o_custkey", "c_mktsegment", "n_name", "n_regionkey")


@query(
    "lookup_default",
    "SELECT doc_id AS user_id, coalesce(quality, 7) AS group_id FROM documents LEFT JOIN labels USING (doc_id)",
)
def lookup_default(spark, folder):
    users = messages(spark, folder).select("user_id")
    return with_group(users, user_groups(spark, folder))


# ------------------------------------------------------------------- folding


@query("reduce_sum", "SELECT sum(o_orderkey)::BIGINT AS total, round(sum(o_totalprice), 2) + 0.0 AS price FROM orders")
def reduce_sum(spark, folder):
    return table(spark, folder, "orders").agg(
        F.sum("o_orderkey").alias("total"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


@query("sum_squares", "SELECT sum(l_partkey * l_partkey)::BIGINT AS total FROM lineitem")
def sum_squares(spark, folder):
    """A bigint like the SQL's; a sum that no bigint holds, where the SQL stops with an error, is a decimal."""
    square = (F.col("l_partkey") * F.col("l_partkey")).cast("decimal(38,0)")
    exact = stage(table(spark, folder, "lineitem").agg(F.sum(square).alias("total")), "total")
    if exact.where(F.col("total") > F.lit((1 << 63) - 1)).take(1):
        return exact
    return exact.select(F.col("total").cast("long").alias("total"))


@query(
    "sum_even_squares",
    "SELECT sum(l_partkey * l_partkey)::BIGINT AS total FROM lineitem WHERE (l_partkey * l_partkey) % 2 = 0",
)
def sum_even_squares(spark, folder):
    squares = table(spark, folder, "lineitem").select((F.col("l_partkey") * F.col("l_partkey")).alias("s"))
    return squares.where(F.col("s") % 2 == 0).agg(F.sum("s").alias("total"))


@query("cos_positive_count", "SELECT count(*) AS n FROM lineitem WHERE cos(l_orderkey) > 0")
def cos_positive_count(spark, folder):
    return table(spark, folder, "lineitem").where(F.cos("l_orderkey") > 0).agg(F.count(F.lit(1)).alias("n"))


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _words(spark, folder):
    return each(spread(table(spark, folder, "documents").select("text")), tok.words(F.col("text")), "word")


@query("shortest_word", f"WITH {WORDS_SQL} SELECT word FROM words ORDER BY length(word), word LIMIT 1")
def shortest_word(spark, folder):
    best = F.min(F.struct(F.length("word").alias("n"), "word"))
    return _words(spark, folder).agg(best.alias("best")).select("best.word")


@query("longest_last_word", f"WITH {WORDS_SQL} SELECT word FROM words ORDER BY length(word) DESC, word DESC LIMIT 1")
def longest_last_word(spark, folder):
    best = F.max(F.struct(F.length("word").alias("n"), "word"))
    return _words(spark, folder).agg(best.alias("best")).select("best.word")


# --------------------------------------------------------------- key → value


def _pairs(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))


@query("reduce_by_key", "SELECT o_custkey AS k, round(sum(o_totalprice), 4) + 0.0 AS v FROM orders GROUP BY 1")
def reduce_by_key(spark, folder):
    return _pairs(spark, folder).groupBy("k").agg(F.round(F.sum("v"), 4).alias("v"))


@query(
    "group_by_key",
    """SELECT k, ((rn - 1) // 8)::BIGINT AS chunk, string_agg(v::VARCHAR, ',' ORDER BY v) AS vs FROM (
         SELECT o_custkey AS k, o_orderkey AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
         FROM orders) GROUP BY 1, 2""",
)
def group_by_key(spark, folder):
    pairs = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    lists = chunked_lists(pairs, "k", "v", 8)
    return lists.select("k", "chunk", F.array_join(F.col("values").cast("array<string>"), ",").alias("vs"))


@query("combine_mean", "SELECT o_custkey AS k, round(sum(o_totalprice) / count(*), 6) + 0.0 AS mean FROM orders GROUP BY 1")
def combine_mean(spark, folder):
    return _pairs(spark, folder).groupBy("k").agg(F.round(F.sum("v") / F.count("v"), 6).alias("mean"))


@query(
    "fold_moments",
    """WITH v AS (SELECT l_returnflag AS k, l_extendedprice AS v FROM lineitem),
       m AS (SELECT k, avg(v) AS mean, count(*) AS n FROM v GROUP BY k),
       d AS (SELECT k, n, mean, avg((v - mean) ** 2) AS second, avg((v - mean) ** 3) AS third FROM v JOIN m USING (k) GROUP BY ALL)
       SELECT k, n, round(mean, 6) AS mean, round(sqrt(second), 6) AS deviation, round(third / second ** 1.5, 6) + 0.0 AS skewness FROM d""",
)
def fold_moments(spark, folder):
    """A state that no built-in aggregate has: count, mean, second and third central moment, merged as they come."""
    finish = lambda s: F.struct(
        s["n"].cast("long").alias("n"), F.round(s["mean"], 6).alias("mean"), F.round(F.sqrt(s["second"] / s["n"]), 6).alias("deviation"),
        F.round(F.sqrt(s["n"]) * s["third"] / F.pow(s["second"], F.lit(1.5)), 6).alias("skewness"),
    )
    rows = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("k"), "l_extendedprice")
    return fold_by_key(rows, ["k"], F.col("l_extendedprice"), *central_moments(), finish).select("k", "folded.*")


@query(
    "fold_key_digest",
    """SELECT o_custkey AS k, count(*) AS n, max(o_orderkey) AS last, bit_xor(o_orderkey) AS mixed FROM orders GROUP BY 1""",
)
def fold_key_digest(spark, folder):
    """Count, largest value and exclusive or in one state per key."""
    create = lambda v: F.struct(F.lit(1).cast("long").alias("n"), v.alias("last"), v.alias("mixed"))
    both = lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), F.greatest(a["last"], b["last"]).alias("last"), a["mixed"].bitwiseXOR(b["mixed"]).alias("mixed"))
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").cast("long").alias("v"))
    folded = fold_by_key(orders, ["k"], F.col("v"), create, lambda a, v: both(a, create(v)), both)
    return folded.select("k", "folded.*")


@query("count_by_key", "SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1")
def count_by_key(spark, folder):
    return _pairs(spark, folder).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("as_map", "SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1")
def as_map(spark, folder):
    # Of several values of a key the last one stays.
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.col("o_custkey").alias("k")).agg(F.max_by("o_totalprice", "o_orderkey").alias("v"))


@query("lookup_key", "SELECT o_totalprice AS v FROM orders WHERE o_custkey = 17")
def lookup_key(spark, folder):
    return _pairs(spark, folder).where(F.col("k") == 17).select("v")


# ------------------------------------------------------------------ grouping


@query(
    "agg_dict",
    "SELECT min(year(o_orderdate))::INTEGER AS first_year, count(o_custkey) AS n FROM orders",
)
def agg_dict(spark, folder):
    rows = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    summary = rows.agg({"year": "min", "o_custkey": "count"})
    return summary.select(F.col("min(year)").alias("first_year"), F.col("count(o_custkey)").alias("n"))


@query(
    "rarest_groups",
    "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n, user_id LIMIT 6",
)
def rarest_groups(spark, folder):
    counts = table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("n", "user_id").limit(6)


@query(
    "sql_group_order",
    """SELECT o_orderpriority AS kind, count(*) AS n, min(year(o_orderdate))::INTEGER AS first_year
       FROM orders GROUP BY 1 ORDER BY n""",
)
def sql_group_order(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("measured")
    return spark.sql(
        """SELECT o_orderpriority AS kind, count(o_orderpriority) AS n, min(year(o_orderdate)) AS first_year
           FROM measured GROUP BY o_orderpriority ORDER BY n"""
    )


@query("rows_per_year", "SELECT year(l_shipdate)::INTEGER AS year, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 1")
def rows_per_year(spark, folder):
    years = table(spark, folder, "lineitem").groupBy(F.year("l_shipdate").alias("year"))
    return years.agg(F.count(F.lit(1)).alias("n")).orderBy("year")


@query(
    "top_groups",
    """SELECT c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY 1 ORDER BY n DESC, c_name LIMIT 5""",
)
def top_groups(spark, folder):
    # Counted per key first: the join sees one row per customer.
    counts = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("m"))
    named = counts.join(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey")
    totals = named.groupBy("c_name").agg(F.sum("m").alias("n"))
    return totals.orderBy(F.col("n").desc(), "c_name").limit(5)


@query(
    "top_groups_of_name",
    """SELECT o_orderpriority, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders
       JOIN customer ON o_custkey = c_custkey WHERE c_name = 'Customer#000000017' GROUP BY 1, 2""",
)
def top_groups_of_name(spark, folder):
    named = table(spark, folder, "customer").where(F.col("c_name") == "Customer#000000017").select("c_custkey")
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderpriority", F.year("o_orderdate").alias("year")
    )
    counts = orders.join(named, "c_custkey").groupBy("o_orderpriority", "year").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "o_orderpriority", "year")


@query(
    "station_coverage",
    """SELECT o_custkey AS station, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY n, station""",
)
def station_coverage(spark, folder):
    kept = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    counts = kept.groupBy(F.col("o_custkey").alias("station")).agg(F.count("o_orderdate").alias("n"))
    return counts.orderBy("n", "station")


@query(
    "multi_key_agg",
    """SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, count(*) AS n, round(avg(o_totalprice), 6) + 0.0 AS mean
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
)
def multi_key_agg(spark, folder):
    # All keys depend on the customer, so the orders are folded before they meet the wide rows.
    totals = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    totals = totals.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    folded = customer.join(totals, "c_custkey").groupBy("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return folded.agg(F.sum("n").alias("n"), F.round(F.sum("s") / F.sum("n"), 6).alias("mean"))


@query("unique_users", "SELECT count(DISTINCT user_id) AS users FROM events")
def unique_users(spark, folder):
    return table(spark, folder, "events").agg(F.count_distinct("user_id").alias("users"))


@query("lookup_table", "SELECT quality AS group_id, count(*) AS users, min(doc_id) AS first_user FROM labels GROUP BY 1")
def lookup_table(spark, folder):
    return user_groups(spark, folder).groupBy("group_id").agg(
        F.count(F.lit(1)).alias("users"), F.min("user_id").alias("first_user")
    )
