"""Projections, filters, scalar functions, sort and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import tokens as tok
from seriesloom.functions import vectors as vec
from seriesloom.operators.profile import min_max_scaled, scaled_units
from seriesloom.operators.series_stats import quality_filter
from seriesloom.operators.sets import subtract_bag
from seriesloom.operators.text import each
from seriesloom.plans.registry import query
from seriesloom.plans.views import DAYS, SERIES_LONG_SQL, WORDS_SQL, r6, series, table
from seriesloom.sources.readers import spread

# ------------------------------------------------------------- element-wise


@query("map_square", "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey * l_partkey AS square FROM lineitem")
def map_square(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_partkey") * F.col("l_partkey")).alias("square")
    )


@query("flatmap_words", f"WITH {WORDS_SQL} SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL")
def flatmap_words(spark, folder):
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    words = each(docs, tok.words(F.col("text")), "word", ("doc_id",))
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query("filter_count", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 30")
def filter_count(spark, folder):
    return table(spark, folder, "lineitem").where(F.col("l_quantity") > 30).agg(F.count(F.lit(1)).alias("n"))


@query("map_values", "SELECT o_custkey AS k, o_orderkey AS id, o_totalprice * 2 AS v FROM orders")
def map_values(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("v")
    )


@query(
    "flatmap_values",
    "SELECT o_custkey AS k, o_orderkey + step AS v FROM orders, (VALUES (0), (1)) AS s(step)",
)
def flatmap_values(spark, folder):
    values = F.sequence(F.col("o_orderkey"), F.col("o_orderkey") + 1)
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.explode(values).alias("v"))


@query("select_cols", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_cols(spark, folder):
    return table(spark, folder, "orders").drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query(
    "sql_range_filter",
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 1300 AND c_acctbal <= 1900",
)
def sql_range_filter(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("people")
    return spark.sql("SELECT c_custkey, c_name FROM people WHERE c_acctbal >= 1300 AND c_acctbal <= 1900")


@query(
    "point_lookup",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_suppkey = 42 AND year(l_shipdate) = 1997""",
)
def point_lookup(spark, folder):
    rows = table(spark, folder, "lineitem").where((F.col("l_suppkey") == 42) & (F.year("l_shipdate") == 1997))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity").orderBy("l_orderkey", "l_linenumber")


@query(
    "case_bucket",
    """SELECT CASE WHEN year(o_orderdate) < 1994 THEN 'early' WHEN year(o_orderdate) < 1997 THEN 'middle'
                   WHEN year(o_orderdate) < 2000 THEN 'late' ELSE 'unknown' END AS period,
              count(*) AS n FROM orders GROUP BY 1""",
)
def case_bucket(spark, folder):
    year = F.year("o_orderdate")
    period = F.when(year < 1994, "early").when(year < 1997, "middle").when(year < 2000, "late").otherwise("unknown")
    return table(spark, folder, "orders").groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "unit_scale",
    f"""WITH {SERIES_LONG_SQL} SELECT station, day,
        round(CASE WHEN measurement IN ('M0', 'M1', 'M2', 'M3') THEN v / 10 ELSE v END, 6) + 0.0 AS v FROM series_long""",
)
def unit_scale(spark, folder):
    long = series(spark, folder).select("station", "measurement", F.posexplode("values").alias("day", "v"))
    scaled = scaled_units(F.col("v"), F.col("measurement"), ["M0", "M1", "M2", "M3"])
    return long.select("station", "day", r6(scaled).alias("v"))


@query(
    "minmax_scale",
    """SELECT s_suppkey, round((s_acctbal - min(s_acctbal) OVER ()) /
       nullif(max(s_acctbal) OVER () - min(s_acctbal) OVER (), 0), 6) + 0.0 AS scaled FROM supplier""",
)
def minmax_scale(spark, folder):
    scaled = min_max_scaled(table(spark, folder, "supplier"), "s_acctbal")
    return scaled.select("s_suppkey", r6(F.col("scaled")).alias("scaled"))


@query(
    "quality_filter",
    f"""WITH {SERIES_LONG_SQL} SELECT station, measurement, (count(*) - count(v))::INTEGER AS missing FROM series_long
        WHERE measurement IN ('M0', 'M1', 'M2', 'M3', 'M4', 'M5') GROUP BY ALL HAVING count(*) - count(v) <= 5""",
)
def quality(spark, folder):
    kept = quality_filter(series(spark, folder), ["M0", "M1", "M2", "M3", "M4", "M5"], max_missing=5)
    return kept.select("station", "measurement", vec.missing(F.col("values")).alias("missing"))


# ------------------------------------------------------------------ scalars


@query(
    "string_funcs",
    f"""WITH {WORDS_SQL} SELECT lower(word) AS word, length(word)::INTEGER AS chars,
        len(string_split(word, ','))::INTEGER AS pieces, word < 'm' AS early, count(*) AS n FROM words GROUP BY ALL""",
)
def string_funcs(spark, folder):
    words = each(spread(table(spark, folder, "documents").select("text")), tok.words(F.col("text")), "w")
    keys = [
        F.lower("w").alias("word"),
        F.length("w").alias("chars"),
        F.size(F.split("w", ",")).alias("pieces"),
        (F.col("w") < "m").alias("early"),
    ]
    return words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "math_funcs",
    """SELECT l_orderkey, l_linenumber, round(pow(l_quantity, 2), 6) + 0.0 AS square, round(abs(l_quantity - 25), 6) + 0.0 AS apart,
       round(cos(l_quantity), 6) + 0.0 AS cosine, round(sqrt(l_extendedprice), 6) + 0.0 AS root,
       round(ln(l_quantity / 50) / ln(2), 6) + 0.0 AS log_ratio FROM lineitem""",
)
def math_funcs(spark, folder):
    q = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        r6(F.pow(q, F.lit(2))).alias("square"),
        r6(F.abs(q - 25)).alias("apart"),
        r6(F.cos(q)).alias("cosine"),
        r6(F.sqrt("l_extendedprice")).alias("root"),
        r6(F.log2(q / 50)).alias("log_ratio"),
    )


@query(
    "dot_norm",
    f"""WITH {SERIES_LONG_SQL} SELECT a.station, round(sum(a.v * a.v), 6) + 0.0 AS square_norm, round(sum(a.v), 6) + 0.0 AS total,
        round(coalesce(sum(a.v * b.v), 0), 6) + 0.0 AS mirrored
        FROM series_long a JOIN series_long b ON a.station = b.station AND b.day = {DAYS - 1} - a.day GROUP BY 1""",
)
def dot_norm(spark, folder):
    values = F.col("values")
    return series(spark, folder).select(
        "station",
        r6(vec.square_norm(values)).alias("square_norm"),
        r6(vec.total(values)).alias("total"),
        r6(vec.dot(values, F.reverse(values))).alias("mirrored"),
    )


# --------------------------------------------------------------------- sort


@query("sort_by_key", "SELECT o_custkey AS k, o_totalprice AS v FROM orders")
def sort_by_key(spark, folder):
    # The value is part of the sort key, so the rows of a frequent key spread over partitions.
    pairs = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    return pairs.orderBy("k", "v")


@query("take_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def take_n(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


# --------------------------------------------------------------------- sets

_BAGS_SQL = """a AS (SELECT o_custkey AS x FROM orders), b AS (SELECT user_id AS x FROM events
               UNION ALL SELECT s_suppkey + 100000000 FROM supplier)"""


def _bags(spark, folder):
    left = table(spark, folder, "orders").select(F.col("o_custkey").alias("x"))
    far = table(spark, folder, "supplier").select((F.col("s_suppkey") + 100000000).alias("x"))
    return left, table(spark, folder, "events").select(F.col("user_id").alias("x")).unionAll(far)


@query(
    "union_bag",
    f"WITH {_BAGS_SQL} SELECT x, count(*) AS n FROM (SELECT x FROM a UNION ALL SELECT x FROM b) GROUP BY x",
)
def union_bag(spark, folder):
    left, right = _bags(spark, folder)
    return left.unionAll(right).groupBy("x").agg(F.count(F.lit(1)).alias("n"))


@query("union_set", f"WITH {_BAGS_SQL} SELECT x FROM a UNION SELECT x FROM b")
def union_set(spark, folder):
    left, right = _bags(spark, folder)
    return left.union(right).distinct()


@query("intersection", f"WITH {_BAGS_SQL} SELECT x FROM a INTERSECT SELECT x FROM b")
def intersection(spark, folder):
    left, right = _bags(spark, folder)
    return left.distinct().intersect(right)  # copies of a value leave before the shuffle


@query("subtract_bag", f"WITH {_BAGS_SQL} SELECT x FROM a WHERE x NOT IN (SELECT x FROM b)")
def subtract(spark, folder):
    return subtract_bag(*_bags(spark, folder))


@query("distinct_vals", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_vals(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()
