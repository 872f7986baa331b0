"""Profiling, sampling, layout and ordered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import vectors as vec
from seriesloom.operators import layout, ordered, profile
from seriesloom.plans.registry import query
from seriesloom.plans.views import SERIES_LONG_SQL, r6, series, table
from seriesloom.staging import stage

DECILES = [i / 10 for i in range(1, 10)]


# What depends on chance or on a sketch is returned as a quantity that does not, next to a flag whether the
# outcome lies within the bounds that it has to keep.


def near(found, expected, deviation):
    """Whether a count lies within six deviations of the one expected."""
    return F.abs(found - expected) <= 6 * deviation + 1


def _binomial(rows, found, share: float):
    return near(found, rows * share, F.sqrt(rows * (share * (1 - share))))


@query("approx_distinct", "SELECT count(DISTINCT o_custkey) AS customers, true AS within FROM orders")
def approx_distinct(spark, folder):
    exact = F.count_distinct("o_custkey").alias("customers")
    found = table(spark, folder, "orders").agg(exact, F.approx_count_distinct("o_custkey", 0.02).alias("sketch"))
    within = F.abs(F.col("sketch") - F.col("customers")) <= 5 * 0.02 * F.col("customers")
    return found.select("customers", within.alias("within"))


@query("approx_quantiles", f"SELECT unnest({DECILES})::DOUBLE AS prob, error::DOUBLE AS error, true AS within FROM (VALUES (0.1), (0.01)) AS e(error)")
def approx_quantiles(spark, folder):
    prices = table(spark, folder, "lineitem").select("l_extendedprice")
    found = None
    for error in (0.1, 0.01):
        one = profile.approx_quantiles(prices, "l_extendedprice", DECILES, error).withColumn("error", F.lit(error))
        found = one if found is None else found.unionByName(one)
    asked = stage(found.agg(F.array_sort(F.collect_list(F.struct("error", "prob", "quantile"))).alias("asked")), "asked")
    at = lambda i: F.get("asked", F.lit(i))
    price = F.col("l_extendedprice")
    marked = prices.withColumn("asked", asked.scalar())
    ranks = [
        F.struct(F.first(at(i)).alias("q"), F.count_if(price < at(i)["quantile"]).alias("below"), F.count_if(price <= at(i)["quantile"]).alias("upto"))
        for i in range(2 * len(DECILES))
    ]
    rows = marked.agg(F.count(price).alias("n"), F.array(*ranks).alias("ranks")).select("n", F.explode("ranks").alias("r"))
    low, high = (F.col("r.q.prob") - F.col("r.q.error")) * F.col("n"), (F.col("r.q.prob") + F.col("r.q.error")) * F.col("n")
    within = (F.col("r.below") <= high + 1) & (F.col("r.upto") >= low - 1)
    return rows.select("r.q.prob", "r.q.error", within.alias("within"))


@query(
    "exact_quantiles",
    f"""SELECT l_returnflag, unnest({DECILES})::DOUBLE AS prob,
        round(unnest(quantile_cont(l_extendedprice, {DECILES})), 6) AS quantile FROM lineitem GROUP BY l_returnflag""",
)
def exact_quantiles(spark, folder):
    q = ordered.exact_quantiles(table(spark, folder, "lineitem"), "l_extendedprice", DECILES, ["l_returnflag"])
    return q.select("l_returnflag", "prob", r6(F.col("quantile")).alias("quantile"))


@query(
    "quantile_summary",
    """SELECT year(o_orderdate)::INTEGER AS year, unnest([0, 0.25, 0.5, 0.75, 1])::DOUBLE AS prob,
       round(unnest(quantile_cont(o_totalprice, [0, 0.25, 0.5, 0.75, 1])), 6) AS quantile
       FROM orders WHERE year(o_orderdate) > 1995 GROUP BY 1""",
)
def quantile_summary(spark, folder):
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    recent = orders.where(F.col("year") > 1995)
    q = ordered.exact_quantiles(recent, "o_totalprice", [0, 0.25, 0.5, 0.75, 1], ["year"])
    return q.select("year", "prob", r6(F.col("quantile")).alias("quantile"))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_cols",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) + 0.0 AS mean, round(stddev_samp({c}), 6) + 0.0 AS stddev,
            min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in _NUMBERS
    ),
)
def describe_cols(spark, folder):
    facts = profile.describe(table(spark, folder, "lineitem"), _NUMBERS)
    return facts.select("column", "n", r6(F.col("mean")).alias("mean"), r6(F.col("stddev")).alias("stddev"), "min", "max")


@query("corr", "SELECT round(corr(l_quantity, l_extendedprice), 6) + 0.0 AS r FROM lineitem")
def corr(spark, folder):
    return table(spark, folder, "lineitem").agg(r6(F.corr("l_quantity", "l_extendedprice")).alias("r"))


@query("cov_samp", "SELECT round(covar_samp(l_quantity, l_extendedprice), 4) + 0.0 AS c FROM lineitem")
def cov_samp(spark, folder):
    return table(spark, folder, "lineitem").agg(F.round(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("c"))


@query(
    "crosstab",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "F", count(*) FILTER (l_linestatus = 'O') AS "O"
       FROM lineitem GROUP BY 1""",
)
def crosstab(spark, folder):
    return profile.crosstab(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "freq_items",
    """SELECT lang AS item, count(*) AS n FROM documents GROUP BY 1
       HAVING count(*) > 0.12 * (SELECT count(*) FROM documents)""",
)
def freq_items(spark, folder):
    return profile.frequent_items(table(spark, folder, "documents"), "lang", 0.12)


SHARES = {"error": 0.5, "purchase": 0.1, "click": 0.01}


@query("sample_by", "SELECT event_type, count(*) AS total, true AS within FROM events GROUP BY 1")
def sample_by(spark, folder):
    events = table(spark, folder, "events")
    kept = events.sampleBy("event_type", SHARES, seed=7).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    share = F.coalesce(*[F.when(F.col("event_type") == kind, part) for kind, part in SHARES.items()], F.lit(0.0))
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("total")).join(kept, "event_type", "left")
    within = near(F.coalesce("n", F.lit(0)), F.col("total") * share, F.sqrt(F.col("total") * share * (1 - share)))
    return totals.select("event_type", "total", within.alias("within"))


@query("sample_frac", "SELECT count(*) AS total, true AS without, true AS with_replacement FROM lineitem")
def sample_frac(spark, folder):
    rows = table(spark, folder, "lineitem")
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    sizes = [rows.sample(withReplacement=w, fraction=0.1, seed=7).agg(F.count(F.lit(1))).scalar() for w in (False, True)]
    counted = total.select("total", sizes[0].alias("n"), sizes[1].alias("m"))
    again = near(F.col("m"), F.col("total") * 0.1, F.sqrt(F.col("total") * 0.1))
    return counted.select("total", _binomial(F.col("total"), F.col("n"), 0.1).alias("without"), again.alias("with_replacement"))


@query(
    "nan_mean",
    f"""WITH {SERIES_LONG_SQL} SELECT measurement, round(avg(v), 6) + 0.0 AS skipping, round(avg(coalesce(v, 0)), 6) + 0.0 AS zero_filled
        FROM series_long GROUP BY 1""",
)
def nan_mean(spark, folder):
    long = series(spark, folder).select("measurement", F.explode("values").alias("v"))
    gappy = long.select("measurement", F.coalesce("v", F.lit(float("nan"))).alias("v"))
    present = F.when(~F.isnan("v"), F.col("v"))
    return gappy.groupBy("measurement").agg(
        r6(F.avg(present)).alias("skipping"), r6(F.avg(F.coalesce(present, F.lit(0.0)))).alias("zero_filled")
    )


@query(
    "na_fill_drop",
    f"""WITH {SERIES_LONG_SQL} SELECT measurement, count(v) AS kept, count(*) AS filled, round(sum(coalesce(v, 0)), 6) + 0.0 AS total,
        count(*) FILTER (v IS NULL) AS replaced FROM series_long GROUP BY 1""",
)
def na_fill_drop(spark, folder):
    long = series(spark, folder).select("measurement", F.explode("values").alias("v"))
    kept = long.na.drop(subset=["v"]).groupBy("measurement").agg(F.count(F.lit(1)).alias("kept"))
    filled = long.na.fill(0.0, ["v"]).groupBy("measurement")
    filled = filled.agg(F.count(F.lit(1)).alias("filled"), r6(F.sum("v")).alias("total"))
    marked = long.na.fill(-999.9, ["v"])
    back = marked.na.replace(-999.9, None, ["v"]).groupBy("measurement")
    back = back.agg(F.sum(F.col("v").isNull().cast("long")).alias("replaced"))
    return kept.join(filled, "measurement").join(back, "measurement")


@query(
    "signal_noise_ratio",
    """SELECT round(max(r), 6) + 0.0 AS max_ratio, round(min(r), 6) + 0.0 AS min_ratio FROM (
       SELECT avg(o_totalprice) / nullif(stddev_samp(o_totalprice), 0) AS r FROM orders GROUP BY year(o_orderdate))""",
)
def signal_noise_ratio(spark, folder):
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    ratios = profile.signal_to_noise(orders, "o_totalprice", "year")
    return ratios.select(r6(F.col("max_ratio")).alias("max_ratio"), r6(F.col("min_ratio")).alias("min_ratio"))


@query(
    "bounding_box",
    """SELECT *, round((min_lat + max_lat) / 2, 6) + 0.0 AS centre_lat, round((min_long + max_long) / 2, 6) + 0.0 AS centre_long,
       round((max_lat - min_lat) / 4, 6) + 0.0 AS margin_lat, round((max_long - min_long) / 4, 6) + 0.0 AS margin_long FROM (
       SELECT min(s_acctbal) AS min_lat, max(s_acctbal) AS max_lat, min(s_nationkey)::DOUBLE AS min_long,
              max(s_nationkey)::DOUBLE AS max_long FROM supplier)""",
)
def bounding_box(spark, folder):
    places = table(spark, folder, "supplier").select("s_acctbal", F.col("s_nationkey").cast("double").alias("east"))
    box = profile.bounding_box(places, "s_acctbal", "east")
    rounded = ["centre_lat", "centre_long", "margin_lat", "margin_long"]
    return box.withColumns({c: r6(F.col(c)) for c in rounded})


@query(
    "histogram",
    """WITH ends AS (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders),
       counts AS (SELECT least(floor((o_totalprice - low) * 10 / (high - low)), 9)::INTEGER AS bin, count(*) AS n
                  FROM orders, ends GROUP BY 1)
       SELECT g.bin::INTEGER AS bin, round(low + g.bin * (high - low) / 10, 4) + 0.0 AS low,
              round(low + (g.bin + 1) * (high - low) / 10, 4) + 0.0 AS high, coalesce(n, 0)::BIGINT AS n
       FROM range(10) AS g(bin) CROSS JOIN ends LEFT JOIN counts ON counts.bin = g.bin""",
)
def histogram(spark, folder):
    bins = profile.histogram(table(spark, folder, "orders"), "o_totalprice")
    return bins.select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


@query(
    "tail_histogram",
    """WITH f AS (SELECT min(value) AS bl, max(value) FILTER (value < 100) AS bh, min(value) FILTER (value >= 100) AS tl,
                  max(value) AS th, round(avg((value = 0)::INTEGER), 6) + 0.0 AS zero_share, round(avg(value), 6) + 0.0 AS mean,
                  round(stddev_pop(value), 6) + 0.0 AS stddev FROM events)
       SELECT value >= 100 AS in_tail, CASE WHEN value >= 100 THEN least(floor((value - tl) * 40 / (th - tl)), 39)
              ELSE least(floor((value - bl) * 20 / (bh - bl)), 19) END::INTEGER AS bin, count(*) AS n,
              zero_share, mean, stddev FROM events, f GROUP BY ALL""",
)
def tail_histogram(spark, folder):
    tails = profile.tail_histogram(table(spark, folder, "events"), "value", 100.0)
    return tails.withColumns({c: r6(F.col(c)) for c in ("zero_share", "mean", "stddev")})


# ------------------------------------------------------------------- ordered


@query(
    "ecdf",
    """SELECT value, min(rn) AS first_rank, max(rn) AS last_rank, round(min(rn) / (any_value(n) + 1), 6) + 0.0 AS p_first,
       round(max(rn) / (any_value(n) + 1), 6) + 0.0 AS p_last FROM (
         SELECT value, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM events) GROUP BY 1""",
)
def ecdf(spark, folder):
    steps = ordered.ecdf(table(spark, folder, "events"), "value")
    return steps.withColumns({c: r6(F.col(c)) for c in ("p_first", "p_last")})


@query(
    "ccdf",
    """SELECT DISTINCT event_type, value, round(1 - cume_dist() OVER (PARTITION BY event_type ORDER BY value), 6) + 0.0 AS p_above
       FROM events""",
)
def ccdf(spark, folder):
    steps = ordered.ccdf(table(spark, folder, "events"), "value", ["event_type"])
    return steps.withColumn("p_above", r6(F.col("p_above")))


@query(
    "neighbour_diff",
    """SELECT g, CASE WHEN count(*) > 1 THEN min(k) END AS first_key, count(*) AS n,
       CASE WHEN count(*) > 1 THEN round(sum(abs(v - p)), 2) END AS sum_abs_diff FROM (
         SELECT o_orderpriority AS g, o_orderkey AS k, o_totalprice AS v,
                lag(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS p FROM orders) GROUP BY 1""",
)
def neighbour_diff(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("g"), "o_orderkey", "o_totalprice")
    walks = ordered.neighbour_diff(orders, "g", "o_orderkey", "o_totalprice")
    return walks.withColumn("sum_abs_diff", F.round("sum_abs_diff", 2))


@query(
    "rank_slices",
    """SELECT piece, g, o_orderkey, o_totalprice FROM (
         SELECT o_orderpriority AS g, o_orderkey, o_totalprice,
                row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS up,
                row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey DESC) AS down FROM orders),
       (VALUES (0, 1, 12, 0, 0), (1, 0, 0, 1, 12), (2, 0, 0, 1, 4), (3, 0, 0, 501, 504), (4, 0, 0, 1001, 1004))
         AS s(piece, u1, u2, d1, d2) WHERE up BETWEEN u1 AND u2 OR down BETWEEN d1 AND d2""",
)
def rank_slices(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("g"), "o_orderkey", "o_totalprice")
    slices = [(0, 12), (-12, None), (-4, None), (-504, -500), (-1004, -1000)]
    return ordered.rank_slices(orders, ["o_totalprice", "o_orderkey"], slices, ["g"])


# -------------------------------------------------------------------- layout


def _totals(sizes, *keys):
    """Rows and partitions, and whether no partition has over twice the mean."""
    level = F.max("n") <= 2 * F.avg("n")
    return sizes.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("partitions"), level.alias("level"))


@query("partition_sizes", "SELECT count(*) AS n, 16 AS partitions, true AS level FROM lineitem")
def partition_sizes(spark, folder):
    keyed = layout.rebalance(table(spark, folder, "lineitem").select("l_orderkey"), 16, "l_orderkey")
    return _totals(layout.partition_sizes(keyed, 16))


@query(
    "rebalance",
    """SELECT layout, count(*) AS n, 10 AS partitions, layout = 'levelled' AS level
       FROM lineitem, (VALUES ('filtered'), ('levelled')) AS l(layout) WHERE l_returnflag = 'R' GROUP BY layout""",
)
def rebalance(spark, folder):
    # A filter on the partitioning key empties most partitions; round robin levels them again.
    keyed = layout.rebalance(table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag"), 10, "l_returnflag")
    few = keyed.where(F.col("l_returnflag") == "R")
    before = layout.partition_sizes(few, 10).withColumn("layout", F.lit("filtered"))
    after = layout.partition_sizes(layout.rebalance(few, 10), 10).withColumn("layout", F.lit("levelled"))
    return _totals(before.unionByName(after), "layout")


@query(
    "missing_per_row",
    f"""WITH {SERIES_LONG_SQL} SELECT station, (count(*) - count(v))::INTEGER AS missing, count(v)::INTEGER AS present
        FROM series_long GROUP BY 1""",
)
def missing_per_row(spark, folder):
    values = F.col("values")
    return series(spark, folder).select("station", vec.missing(values).alias("missing"), vec.present(values).alias("present"))
