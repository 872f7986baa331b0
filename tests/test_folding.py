"""Folds with the caller's functions, and samples of a given size."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import folding


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds half of the rows; some keys and values are NULL."""
    rng = np.random.default_rng(4)
    rows = [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else f"k{rng.integers(40)}", i, None if rng.random() < 0.1 else float(rng.gamma(2.0))) for i in range(5000)]
    return rows, spark.createDataFrame(rows, "k string, id long, v double").repartition(11)


def moments(values):
    v = np.array(values)
    return len(v), v.mean(), ((v - v.mean()) ** 2).sum(), ((v - v.mean()) ** 3).sum()


@pytest.mark.parametrize("block_rows, parts", [(200_000, 64), (50, 3), (1, 1)])
def test_moments_of_a_crowded_key(skewed, block_rows, parts):
    rows, df = skewed
    got = folding.fold_by_key(df, ["k"], F.col("v"), *folding.central_moments(), parts=parts, block_rows=block_rows).collect()
    groups = {}
    for key, _, v in rows:
        if v is not None:
            groups.setdefault(key, []).append(v)
    assert {r.k for r in got} == set(groups) and len(got) == len(groups)
    for r in got:
        assert tuple(r.folded) == pytest.approx(moments(groups[r.k]), rel=1e-9, abs=1e-9)


def test_any_type_of_state(skewed):
    """A state of three longs, over two keys, with a last step."""
    rows, df = skewed
    state = lambda n, low, high: F.struct(n.alias("n"), low.alias("low"), high.alias("high"))
    create = lambda v: state(F.lit(1).cast("long"), v, v)
    both = lambda a, b: state(a["n"] + b["n"], F.least(a["low"], b["low"]), F.greatest(a["high"], b["high"]))
    keyed = df.withColumn("odd", F.col("id") % 2)
    got = folding.fold_by_key(keyed, ["k", "odd"], F.col("id"), create, lambda a, v: both(a, create(v)), both, lambda s: s["high"] - s["low"] + s["n"], "x", 4, 333)
    groups = {}
    for key, i, _ in rows:
        groups.setdefault((key, i % 2), []).append(i)
    assert {(r.k, r.odd): r.x for r in got.collect()} == {k: max(v) - min(v) + len(v) for k, v in groups.items()}


def test_without_keys_and_without_rows(spark, skewed):
    rows, df = skewed
    fold = lambda frame, by: folding.fold_by_key(frame, by, F.col("id"), lambda v: v, lambda a, v: a + v, lambda a, b: a + b, block_rows=70)
    assert fold(df.withColumn("all", F.lit(0)), ["all"]).first().folded == sum(range(5000))
    assert fold(df.limit(0), ["k"]).collect() == []
    assert folding.fold_by_key(df, ["k"], F.lit(None).cast("long"), lambda v: v, lambda a, v: a, lambda a, b: a).collect() == []


def test_values_are_folded_before_the_shuffle(skewed):
    """What is exchanged are states, not values: the first exchange stands above the folding projection."""
    _, df = skewed
    text = folding.fold_by_key(df, ["k"], F.col("v"), *folding.central_moments())._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning(k") < text.index("MapInArrow")
    assert text.rindex("Exchange hashpartitioning(k") < text.index("MapInArrow")


@pytest.mark.parametrize("k", [1, 37, 1500])
def test_samples_have_the_size_and_do_not_depend_on_the_layout(spark, skewed, k):
    rows, df = skewed
    one, many = (sorted(map(repr, folding.bounded_sample(x, ["k"], ["id"], k, 3).collect())) for x in (df.coalesce(1), df.repartition(23)))
    assert one == many
    groups = {}
    for key, i, _ in rows:
        groups.setdefault(key, []).append((hashlib.md5(f"3|{i}".encode()).hexdigest(), i))
    got = folding.bounded_sample(df, ["k"], ["id"], k, 3).collect()
    assert {(r.k, r.id, r.draw) for r in got} == {(key, i, n) for key, v in groups.items() for n, (_, i) in enumerate(sorted(v)[:k], 1)}


def test_samples_of_parts_can_be_merged(skewed):
    _, df = skewed
    parts = [folding.bounded_sample(df.where(F.col("id") % 3 == i), ["k"], ["id"], 20).drop("draw") for i in range(3)]
    merged = folding.bounded_sample(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k"], ["id"], 20)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, folding.bounded_sample(df, ["k"], ["id"], 20).collect()))


def test_order_of_the_rows_does_not_matter(spark):
    random.seed(1)
    rows = [("a", float(i)) for i in range(200)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    for frame in (df, df.orderBy("v"), df.repartition(9)):
        assert tuple(folding.fold_by_key(frame, ["k"], F.col("v"), *folding.central_moments(), block_rows=13).first().folded) == pytest.approx(moments(range(200)), abs=1e-6)
