import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one value, and one group holds most rows."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(6000) < 0.34, 5.0, np.round(rng.normal(5, 3, 6000), 2))
    groups = np.where(rng.random(6000) < 0.7, "hot", np.where(rng.random(6000) < 0.9, "warm", "cold"))
    pdf = pd.DataFrame({"g": groups, "v": values, "id": np.arange(6000)})
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_running_counts_with_a_frequent_value(skewed):
    pdf, df = skewed
    got = ordered.running_counts(df, "v").orderBy("v").toPandas()
    expected = pdf.groupby("v").size()
    assert got["n"].tolist() == expected.tolist()
    assert got["before"].tolist() == (expected.cumsum() - expected).tolist()
    assert set(got["total"]) == {len(pdf)}


def test_exact_quantiles_equal_numpy(skewed):
    pdf, df = skewed
    probs = [0, 0.001, 0.25, 1 / 3, 0.5, 0.99, 1]
    got = ordered.exact_quantiles(df, "v", probs, ["g"]).collect()
    assert len(got) == 3 * len(probs)
    for row in got:
        assert row["quantile"] == pytest.approx(np.quantile(pdf[pdf.g == row["g"]].v, row["prob"]))


def test_ranks_do_not_depend_on_the_partitions(skewed):
    _, df = skewed
    one = sorted(map(tuple, ordered.ecdf(df.coalesce(1), "v", ["g"]).collect()))
    many = sorted(map(tuple, ordered.ecdf(df.repartition(23), "v", ["g"]).collect()))
    assert one == many


def test_null_and_nan_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,)], "v double")
    assert sorted(map(tuple, ordered.ccdf(df, "v").collect())) == [(1.0, 0.5), (2.0, 0.0)]


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), ("a", 5), (None, 3)], "g string, v int")
    rows = {(r["g"], r["v"]): (r["before"], r["total"]) for r in ordered.running_counts(df, "v", ["g"]).collect()}
    assert rows == {(None, 1): (0, 2), (None, 3): (1, 2), ("a", 5): (0, 1)}


def test_place_rows_numbers_every_group(skewed):
    pdf, df = skewed
    got = ordered.place_rows(df, ["id"], ["g"]).toPandas().set_index("id").sort_index()
    assert got["before"].tolist() == pdf.groupby("g").cumcount().tolist()


def test_rank_slices_are_list_slices(skewed):
    pdf, df = skewed
    slices = [(0, 12), (3, 5), (-12, None), (-4, None), (-504, -500), (-1004, -1000)]
    for by in ([], ["g"]):
        got = ordered.rank_slices(df, ["v", "id"], slices, by).toPandas()
        for group in [None] if not by else sorted(set(pdf.g)):
            rows = pdf if group is None else pdf[pdf.g == group]
            ids = rows.sort_values(["v", "id"])["id"].tolist()
            for i, (start, stop) in enumerate(slices):
                piece = got[(got.piece == i) & ((got.g == group) if group else True)]
                assert sorted(piece["id"]) == sorted(ids[start:stop]), (group, i)


def test_top_per_group_prunes_before_the_shuffle(skewed, capsys):
    _, df = skewed
    ordered.top_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 10).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_chunked_lists_hold_everything_in_bounded_pieces(skewed):
    pdf, df = skewed
    got = ordered.chunked_lists(df, "g", "v", 100).toPandas()
    assert got["values"].map(len).max() == 100
    for group, rows in got.sort_values("chunk").groupby("g"):
        assert sum(map(list, rows["values"]), []) == sorted(pdf[pdf.g == group].v)


def test_neighbour_diff_of_multiples_of_five(spark):
    df = spark.range(0, 1_000_000, 5).select((F.col("id") % 10).alias("g"), "id", F.col("id").alias("v"))
    got = {tuple(r) for r in ordered.neighbour_diff(df.repartition(9), "g", "id", "v").collect()}
    assert got == {(0, 0, 100_000, 999_990.0), (5, 5, 100_000, 999_990.0)}


def test_neighbour_diff_with_repeats_and_single_rows(spark):
    rows = [("a", 1, 5.0), ("a", 1, 5.0), ("a", 2, 3.0), ("b", 9, 1.0)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    got = {tuple(r) for r in ordered.neighbour_diff(df, "g", "k", "v").collect()}
    assert got == {("a", 1, 3, 2.0), ("b", None, 1, None)}


def test_cumulative_share_starts_at_zero(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 1.0)], "g string, rank int, w double")
    assert sorted(map(tuple, ordered.cumulative_share(df, "w", "rank", ["g"]).collect())) == [
        ("a", 0, 0.0),
        ("a", 1, 0.75),
        ("a", 2, 1.0),
    ]


def test_long_runs_of_one_value_fill_many_chunks(spark):
    df = spark.range(50_000).select(F.lit("k").alias("k"), F.lit(7).alias("v"))
    got = ordered.chunked_lists(df, "k", "v", 5).agg(F.count("*"), F.max("chunk"), F.sum(F.size("values"))).first()
    assert tuple(got) == (10_000, 9_999, 50_000)


def test_quantiles_meet_over_many_stretches(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(ordered, "STRETCH", 7)
    for row in ordered.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"]).collect():
        assert row["quantile"] == pytest.approx(np.quantile(pdf[pdf.g == row["g"]].v, row["prob"]))


# ---------------------------------------------------- quantiles by brackets


def places(df, probs, by, accuracy):
    return {(r["g"] if by else None, r["prob"]): r["quantile"] for r in ordered.exact_quantiles(df, "v", probs, by, accuracy).collect()}


@pytest.mark.parametrize("accuracy", [20, 100])
def test_quantiles_inside_brackets_equal_numpy(skewed, accuracy):
    """Groups beyond ten times the accuracy are bracketed; one value holds a third of the rows."""
    pdf, df = skewed
    probs = [0, 0.001, 0.1, 0.25, 1 / 3, 0.5, 0.51, 0.9, 0.999, 1]
    for (group, prob), quantile in places(df, probs, ["g"], accuracy).items():
        assert quantile == pytest.approx(np.quantile(pdf[pdf.g == group].v, prob)), (group, prob)
    for (_, prob), quantile in places(df, probs, [], accuracy).items():
        assert quantile == pytest.approx(np.quantile(pdf.v, prob))


def test_only_few_values_are_sorted(skewed, monkeypatch):
    """Of 200,000 distinct values what is put in order is a small part, and no plan sorts them all."""
    sorted_rows, staged = [], ordered.stage

    def watch(df, label="staged"):
        table = staged(df, label)
        if label == "slots":
            sorted_rows.append(table.count())
        return table

    monkeypatch.setattr(ordered, "stage", watch)
    spark = skewed[1].sparkSession
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_000_007).cast("double").alias("v"))
    values = np.array([r[0] for r in df.collect()])
    for r in ordered.exact_quantiles(df, "v", [0.1, 0.5, 0.9]).collect():
        assert r["quantile"] == pytest.approx(np.quantile(values, r["prob"]))
    assert len(sorted_rows) == 1 and sorted_rows[0] < 0.02 * len(values)


def test_quantiles_where_the_sketch_misses(skewed, monkeypatch):
    """Brackets beside the wanted places are noticed, and the groups are sorted."""
    pdf, df = skewed
    right = ordered._bracketed

    def wrong(rows, value, probs, by, accuracy):
        spoiled = F.transform("ends_", lambda end: end - 100)
        return right(rows, value, probs, by, accuracy).withColumn("ends_", F.when(F.col("g") == "hot", spoiled).otherwise(F.col("ends_")) if by else spoiled)

    monkeypatch.setattr(ordered, "_bracketed", wrong)
    for by in (["g"], []):
        for (group, prob), quantile in places(df, [0.25, 0.5], by, 20).items():
            assert quantile == pytest.approx(np.quantile(pdf[pdf.g == group].v if by else pdf.v, prob))


def test_quantiles_of_nulls_and_integers(spark):
    df = spark.createDataFrame([(None, 1), (None, 4), ("a", None), ("b", 2**40), ("b", 2**40 + 1)], "g string, v long")
    assert places(df, [0.5], ["g"], 2000) == {(None, 0.5): 2.5, ("b", 0.5): 2**40 + 0.5}
    assert places(df.where("g = 'a'"), [0.5], ["g"], 2000) == {}


def test_neighbour_diff_has_one_line_per_partition(spark, monkeypatch):
    """Batches of a partition are chained where they are, also for one group of all rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(20_000).select(F.when(F.col("id") < 19_990, "hot").alias("g"), "id", (F.col("id") * 37 % 1009).cast("double").alias("v"))
        got = {r["g"]: tuple(r)[1:] for r in ordered.neighbour_diff(df.repartition(9), "g", "id", "v").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    walk = lambda ids: float(np.abs(np.diff([i * 37 % 1009 for i in ids])).sum())
    assert got == {"hot": (0, 19_990, walk(range(19_990))), None: (19_990, 10, walk(range(19_990, 20_000)))}
