"""Inputs that ordinary tables do not hold: NULL keys, NaN, infinities, ragged vectors, large integers, early positions."""

import math

import pytest

from seriesloom.operators import decompose, geometry, ordered, profile, series_stats, smoothing
from seriesloom.operators.spacetime import TwoWayCentering
from seriesloom.sources import readers

NAN, INF = float("nan"), float("inf")


def plain(value):
    """Values in a form that compares equal, NaN included; numbers to 9 places."""
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (value if math.isinf(value) else round(value, 9) + 0.0)
    return value


def test_both_fits_agree_on_awkward_vectors(spark, monkeypatch):
    rows = [
        (0, "a", [1.0, 2.0, NAN]), (1, "a", [1.0, None, 3.0]), (2, "a", [INF, 1.0, 2.0]), (3, "a", None), (4, "a", [1.0, 2.0]),
        (5, "a", [1.0, 2.0, 3.0, 4.0]), (6, None, [1.0, 2.0, 3.0]), (7, "none", [1.0, 2.0, 3.0]), (8, "a", []), (9, "b", [2.0, -INF, 0.0]),
    ]
    series = spark.createDataFrame(rows, "id int, g string, values array<double>")
    basis = spark.createDataFrame(
        [("a", [0.5, 0.0, 1.0], [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]), (None, [1.0, 1.0, 1.0], [[0.0, 0.0, 1.0]]), ("b", [0.0, 0.0, 0.0], [[0.0, 0.0, 1.0]])],
        "g string, mean array<double>, vectors array<array<double>>",
    )
    found = {}
    for limit in (decompose.DENSE_BASIS, 0):
        monkeypatch.setattr(decompose, "DENSE_BASIS", limit)
        out = decompose.decompose(series, basis, 2, ["g"]).drop("values").orderBy("id").collect()
        found[limit] = [plain(tuple(r)) for r in out]
    one, two = found.values()
    assert one == two
    assert one[0][2:4] == (0.5, 2.0) and one[6][2] == 2.0 and one[3][2] is None and one[7][2] is None


def test_null_groups_stay(spark):
    rows = [(g, [float(i), float(i * i % 7), 1.0 * (i % 3)]) for i in range(12) for g in (None, "a")]
    series = spark.createDataFrame(rows, "g string, values array<double>")
    assert {r.g for r in series_stats.value_stats(series, ["g"]).collect()} == {None, "a"}
    cov = series_stats.covariance(series, ["g"]).collect()
    assert {(r.i, r.j, plain(r.cov)) for r in cov if r.g is None} == {(r.i, r.j, plain(r.cov)) for r in cov if r.g == "a"}
    assert {r.g for r in decompose.component_basis(series, ["g"], 2).collect()} == {None, "a"}


def test_large_offsets_do_not_cancel(spark):
    series = spark.createDataFrame([("a", [1e8 + i]) for i in (1, 2, 3)], "g string, values array<double>")
    assert series_stats.variances(series, ["g"]).first()["var"] == pytest.approx(2 / 3)
    assert series_stats.covariance(series, ["g"]).first()["cov"] == pytest.approx(2 / 3)
    curve = series_stats.mean_std_curves(series, ["g"]).first()
    assert curve["mean_plus_std"] - curve["mean"] == pytest.approx(math.sqrt(2 / 3), abs=1e-6)


def test_ranges_leave_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (NAN,), (INF,), (-INF,), (None,)], "v double")
    assert [r.n for r in profile.histogram(df, "v", 2).orderBy("bin").collect()] == [1, 1]
    assert [r.scaled for r in profile.min_max_scaled(df, "v").collect()] == [0.0, 1.0, None, None, None, None]
    assert sum(r.n for r in profile.tail_histogram(df, "v", 2.0).collect()) == 2


def test_null_labels_and_items(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, "a", 4.0), (2, None, 6.0), (2, None, 8.0)], "k int, label string, v double")
    wide = profile.pivot_mean(df, "k", "label", "v", "c_")
    assert wide.columns == ["k", "c_null", "c_a"] and {tuple(r) for r in wide.collect()} == {(1, 2.0, 4.0), (2, 7.0, None)}
    assert {tuple(r) for r in profile.pair_means(df, "k", "label", "v").collect()} == {(1, None, 2.0), (1, "a", 4.0), (2, None, 7.0)}
    assert {tuple(r) for r in profile.pair_counts(df, "k", "label").collect()} == {(1, None, 1), (1, "a", 1), (2, None, 2)}
    assert {tuple(r) for r in profile.frequent_items(df, "label", 0.5).collect()} == {(None, 3)}


def test_neighbours_skip_missing_values(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 4.0), ("a", 4, 2.0), (None, 1, 5.0), (None, 2, 7.0), ("b", 1, 1.0), ("c", 1, None)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    got = {r.g: (r.first_key, r.n, r.sum_abs_diff) for r in ordered.neighbour_diff(df, "g", "k", "v").collect()}
    assert got == {"a": (1, 3, 5.0), None: (1, 2, 2.0), "b": (None, 1, None)}


def test_signals_may_start_before_zero(spark):
    rows = [(g, p, float(p)) for g in ("s", None) for p in range(-5, 4)]
    df = spark.createDataFrame(rows, "g string, p long, v double")
    got = {(r.g, r.p): r.smooth for r in smoothing.smooth_signal(df, ["g"], "p", "v", order=3, std=1.0, length=4).collect()}
    weights = smoothing.gaussian_window(3, 1.0)
    for g in ("s", None):
        for p in range(-5, 4):
            near = [(q, w) for q, w in zip((p - 1, p, p + 1), weights) if -5 <= q < 4]
            assert got[g, p] == pytest.approx(sum(q * w for q, w in near) / sum(w for _, w in near))
    assert len(got) == 18


def test_missing_vectors_are_filled(spark):
    rows = [(1, "m", year, values) for year, values in ((2000, [1.0] * 4), (2001, None), (2002, [3.0] * 4))]
    series = spark.createDataFrame(rows, "station long, measurement string, year int, values array<double>")
    got = smoothing.smooth_series(series, days=4, order=5, std=2.0).orderBy("year").collect()
    assert len(got) == 3
    assert got[1]["values"][0] == pytest.approx(1.0) and got[1]["values"][3] == pytest.approx(3.0)


def test_cells_without_keys_take_no_part(spark):
    rows = [(y, s, float(y * s % 5)) for y in range(4) for s in range(3)]
    known = spark.createDataFrame(rows, "year int, station int, v double")
    more = known.unionByName(spark.createDataFrame([(None, 1, 100.0), (1, None, 100.0)], "year int, station int, v double"))
    trace = lambda cells: [plain(tuple(r)) for r in TwoWayCentering(cells).run(2).trace().collect()]
    assert trace(known) == trace(more)


def test_large_points_and_bad_lines(spark):
    lines = spark.createDataFrame([("3000000000 1",), ("1 2 3",), ("x y",), ("",), (None,), (" -7   8 ",)], "value string")
    good, bad = geometry.split_points(lines)
    assert {tuple(r) for r in good.collect()} == {(3000000000, 1), (-7, 8)}
    assert {r.raw for r in bad.collect()} == {"1 2 3", "x y"}


def test_csv_of_large_keys(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n3000000000,1_000\n2,2\n")
    schema = lambda: readers.infer_csv_schema(spark, str(tmp_path))
    with pytest.raises(readers.BadCsvFormat):
        schema()  # 1_000 is no number for Spark's reader
    (tmp_path / "a.csv").write_text("k,v\n3000000000,1\n2,2\n")
    (tmp_path / "b.csv").write_text("k,v\n" + "oops,1\n" * 2000)  # the larger file does not give the head
    parsed = readers.read_csv_with_bad_lines(spark, str(tmp_path))
    assert {r.k for r in parsed.good.collect()} == {3000000000, 2} and parsed.bad.count() == 2000


def test_outer_joins_with_a_crowded_key(spark):
    from seriesloom.operators.sets import skewed_outer_join

    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, x string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 1), (None, 2)], "k int, y int")
    for how in ("left", "full"):
        got, usual = skewed_outer_join(left, right, "k", how).select("k", "x", "y"), left.join(right, "k", how).select("k", "x", "y")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, usual.collect()))
