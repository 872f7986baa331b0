import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import layout, profile, sets


def test_sketches_stay_within_their_errors(spark):
    df = spark.range(50_000).select((F.col("id") % 7919).alias("u"), F.col("id").cast("double").alias("v"))
    found = df.agg(F.approx_count_distinct("u", 0.02)).first()[0]
    assert abs(found - 7919) <= 3 * 0.02 * 7919
    for row in profile.approx_quantiles(df, "v", [0.1, 0.5, 0.9], 0.01).collect():
        assert abs(row["quantile"] / 50_000 - row["prob"]) <= 0.01


def test_samples_have_the_expected_size(spark, tables):
    n = 100_000
    share = 0.1
    got = spark.range(n).sample(False, share, seed=3).count()
    assert abs(got - n * share) < 5 * np.sqrt(n * share * (1 - share))
    df = spark.range(n).select((F.col("id") % 2).alias("k"))
    strata = {r["k"]: r["count"] for r in df.sampleBy("k", {0: 0.5}, seed=3).groupBy("k").count().collect()}
    assert set(strata) == {0} and abs(strata[0] - n / 4) < 5 * np.sqrt(n / 8)


def test_frequent_items_has_no_false_ones(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [(f"x{i}",) for i in range(10)], "v string")
    got = {tuple(r) for r in profile.frequent_items(df, "v", 0.25).collect()}
    assert got == {("a", 60), ("b", 30)}


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = profile.histogram(df, "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram(values, 10)
    assert [r["n"] for r in rows] == counts.tolist()
    assert np.allclose([r["low"] for r in rows], edges[:-1])


def test_histogram_of_one_value(spark):
    rows = profile.histogram(spark.createDataFrame([(4.0,)] * 3, "v double"), "v", 2).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 0]


def test_scaling_without_a_range_is_null(spark):
    df = profile.min_max_scaled(spark.createDataFrame([(4.0,)] * 2, "v double"), "v")
    assert {r["scaled"] for r in df.collect()} == {None}


def test_wide_tables_have_a_limit(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("r"), F.col("id").alias("c"))
    with pytest.raises(ValueError):
        profile.distinct_labels(df, "c", limit=10)
    assert len(profile.crosstab(df, "r", "c").columns) == 51


def test_groups_without_spread_have_no_ratio(spark):
    rows = [(1, 2.0), (1, 2.0), (2, 5.0), (3, 1.0), (3, 3.0)]
    row = profile.signal_to_noise(spark.createDataFrame(rows, "y int, v double"), "v", "y").first()
    assert row["max_ratio"] == row["min_ratio"] == pytest.approx(2 / np.sqrt(2))


def test_subtract_keeps_duplicates(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "v int")
    right = spark.createDataFrame([(1,), (4,), (None,)], "v int")
    assert sorted(r[0] for r in sets.subtract_bag(left, right).collect()) == [2, 3, 3]


def test_rebalancing_levels_a_filtered_table(spark):
    keyed = spark.range(10_000).repartition(10, F.col("id") % 10).where(F.col("id") % 5 == 0)
    before = [r["n"] for r in layout.partition_sizes(keyed, 10).collect()]
    after = [r["n"] for r in layout.partition_sizes(layout.rebalance(keyed, 10), 10).collect()]
    assert sum(before) == sum(after) == 2000
    assert before.count(0) >= 8 and max(after) - min(after) <= 10


def test_key_value_lessons(spark):
    """Fixed values of the usual lessons on key-value data."""
    kv = spark.createDataFrame([(1, 2), (2, 4), (2, 6)], "k int, v int")
    assert sorted(map(tuple, kv.groupBy("k").agg(F.sum("v")).collect())) == [(1, 2), (2, 10)]
    assert {r["k"]: r["m"] for r in kv.groupBy("k").agg(F.max_by("v", "v").alias("m")).collect()} == {1: 2, 2: 6}
    left = spark.createDataFrame([(1, 2), (2, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(2, 5), (3, 1)], "k int, b int")
    inner = {(2, 1, 5), (2, 2, 5)}
    joined = {how: {tuple(r) for r in left.join(right, "k", how).collect()} for how in ("inner", "left", "right", "full")}
    assert joined["inner"] == inner
    assert joined["left"] == inner | {(1, 2, None)}
    assert joined["right"] == inner | {(3, None, 1)}
    assert joined["full"] == joined["left"] | joined["right"]
    assert [tuple(r) for r in left.join(right, "k", "left_anti").collect()] == [(1, 2)]


def test_means_with_and_without_missing(spark):
    values = [1.0, None, 2.0, None, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(F.avg("v")).first()[0] == 3.0
    assert df.na.fill(0.0).agg(F.avg("v")).first()[0] == pytest.approx(15 / 7)
