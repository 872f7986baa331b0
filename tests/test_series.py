import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.functions import vectors as vec
from seriesloom.operators import decompose as dec
from seriesloom.operators import ordered
from seriesloom.operators import series_stats as stats

D, K = 12, 4


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(11)
    waves = rng.normal(size=(80, 3)) @ rng.normal(size=(3, D)) + 0.1 * rng.normal(size=(80, D)) + 2
    waves[rng.random(waves.shape) < 0.1] = np.nan
    return waves


@pytest.fixture(scope="module")
def series(spark, matrix):
    rows = [
        (f"s{i}", "A" if i % 3 else "B", 1950 + i, [None if np.isnan(v) else float(v) for v in row])
        for i, row in enumerate(matrix)
    ]
    return spark.createDataFrame(rows, "station string, measurement string, year int, values array<double>").repartition(5)


def part(matrix, name):
    return matrix[[i for i in range(len(matrix)) if ("A" if i % 3 else "B") == name]]


def covariance(m):
    z, ok = np.nan_to_num(m), ~np.isnan(m)
    mean = np.nanmean(m, axis=0)
    return (z.T @ z) / (ok.T.astype(float) @ ok) - np.outer(mean, mean)


def test_second_moments_and_covariance(series, matrix):
    moments = stats.second_moments(series, ["measurement"]).toPandas()
    cov = stats.covariance(series, ["measurement"]).toPandas()
    assert len(moments) == len(cov) == 2 * D * (D + 1) // 2
    for name in "AB":
        m = part(matrix, name)
        z, ok = np.nan_to_num(m), (~np.isnan(m)).astype(int)
        for row in moments[moments.measurement == name].itertuples():
            assert row.o == pytest.approx((z.T @ z)[row.i, row.j])
            assert row.no == (ok.T @ ok)[row.i, row.j]
        for row in cov[cov.measurement == name].itertuples():
            assert row.cov == pytest.approx(covariance(m)[row.i, row.j], abs=1e-9)


def test_statistics_do_not_depend_on_the_partitions(series):
    one = stats.second_moments(series.coalesce(1), ["measurement"]).orderBy("measurement", "i", "j").toPandas()
    many = stats.second_moments(series.repartition(17), ["measurement"]).orderBy("measurement", "i", "j").toPandas()
    pd.testing.assert_frame_equal(one, many)


def test_many_groups_pass_the_held_matrices(series, monkeypatch):
    usual = stats.second_moments(series, ["station"]).orderBy("station", "i", "j").toPandas()
    monkeypatch.setattr(stats, "HELD_BYTES", 1)
    handed_on = stats.second_moments(series.coalesce(1), ["station"]).orderBy("station", "i", "j").toPandas()
    assert usual["station"].nunique() == 80
    pd.testing.assert_frame_equal(usual, handed_on)


def test_variances_are_the_diagonal(series):
    cov = stats.covariance(series, ["measurement"]).where("i = j").select("measurement", F.col("i").alias("day"), "cov")
    both = stats.variances(series, ["measurement"]).join(cov, ["measurement", "day"]).collect()
    assert len(both) == 2 * D
    assert all(r["var"] == pytest.approx(r["cov"]) for r in both)


def test_value_stats(series, matrix):
    for row in stats.value_stats(series, ["measurement"]).collect():
        m = part(matrix, row["measurement"])
        values = m[~np.isnan(m)]
        assert row["n"] == len(values)
        assert row["std"] == pytest.approx(values.std())
        assert row["low100"] == pytest.approx(np.quantile(values, 0.01))
        assert row["high1000"] == pytest.approx(np.quantile(values, 0.999))


def test_principal_components(series, matrix):
    found = stats.principal_components(series, ["measurement"]).orderBy("measurement", "rank").toPandas()
    for name in "AB":
        rows = found[found.measurement == name]
        values, vectors = rows.eigval.to_numpy(), np.stack(rows.eigvec.to_numpy())
        cov = covariance(part(matrix, name))
        assert np.allclose(vectors @ vectors.T, np.eye(D), atol=1e-8)
        assert np.allclose(cov @ vectors.T, vectors.T * values, atol=1e-8)
        assert values.sum() == pytest.approx(np.trace(cov))
        assert np.all(np.diff(values) <= 1e-12)
        assert all(v[np.abs(v).argmax()] > 0 for v in vectors)


def test_explained_share_ends_at_one(series):
    shares = ordered.cumulative_share(stats.principal_components(series, ["measurement"]), "eigval", "rank", ["measurement"])
    ends = shares.where(F.col("rank").isin(0, D)).orderBy("measurement", "rank").collect()
    assert [round(r["share"], 9) for r in ends] == [0.0, 1.0, 0.0, 1.0]


def test_decomposition_on_components(series, matrix):
    basis = dec.component_basis(series, ["measurement"], K)
    got = dec.decompose(series, basis, K, ["measurement"]).toPandas().set_index("station")
    bases = {r["measurement"]: r for r in basis.collect()}
    for i, row in enumerate(matrix):
        b = bases["A" if i % 3 else "B"]
        rest = np.nan_to_num(row - np.array(b["mean"]))
        total = np.nansum(row**2)
        line = got.loc[f"s{i}"]
        assert line.total_var == pytest.approx(total)
        assert line.res_mean == pytest.approx(rest @ rest / total)
        shares = [line.res_mean]
        r0 = rest.copy()
        for k, u in enumerate(map(np.array, b["vectors"]), 1):
            assert line[f"coeff_{k}"] == pytest.approx(r0 @ u)
            rest = rest - (r0 @ u) * u
            assert line[f"res_{k}"] == pytest.approx(rest @ rest / total, abs=1e-9)
            shares.append(line[f"res_{k}"])
        assert np.all(np.diff(shares) <= 1e-9)


def test_large_bases_are_joined_with_the_same_result(series, monkeypatch):
    basis = dec.component_basis(series, ["measurement"], K)
    dense = dec.decompose(series, basis, K, ["measurement"]).toPandas().set_index("station").sort_index()
    monkeypatch.setattr(dec, "DENSE_BASIS", 0)
    joined = dec.decompose(series, basis, K, ["measurement"]).toPandas().set_index("station").sort_index()
    numbers = [c for c in dense.columns if c.startswith(("coeff", "res", "total"))]
    assert np.allclose(dense[numbers], joined[numbers], atol=1e-9)


def test_series_without_a_basis_stay(series, monkeypatch):
    basis = dec.component_basis(series.where("measurement = 'A'"), ["measurement"], 2)
    for limit in (dec.DENSE_BASIS, 0):
        monkeypatch.setattr(dec, "DENSE_BASIS", limit)
        got = dec.decompose(series, basis, 2, ["measurement"])
        assert got.count() == 80
        assert got.where("measurement = 'B' AND coeff_1 IS NOT NULL").count() == 0


def test_fourier_basis_is_orthonormal_and_reconstructs(spark):
    days = 365
    table = dec.fourier_basis(spark, days)
    everywhere = spark.range(days).select(F.col("id").cast("int").alias("day"), F.lit(0.5).alias("share"))
    for row in dec.gram(table, everywhere).collect():
        assert row["product"] == pytest.approx(float(row["f"] == row["g"]), abs=1e-9)
        assert row["present_product"] == pytest.approx(row["product"] / 2)
    x = np.arange(days) * 2 * np.pi / days
    signal = 2 * np.sin(x) - 4 * np.sin(3 * x)
    df = spark.createDataFrame([("w", [float(v) for v in signal])], "station string, values array<double>")
    basis = dec.basis_row(table)
    curve = [r["residual"] for r in dec.residual_curve(df, basis, 9).orderBy("i").collect()]
    assert curve[0] == pytest.approx(np.linalg.norm(signal))
    assert np.all(np.diff(curve) <= 1e-9) and curve[-1] == pytest.approx(0, abs=1e-6)
    last = dec.reconstruct(df, basis, 9).where("k = 9").first()["approximation"]
    assert np.allclose(last, signal)


def test_zero_series_has_no_shares(spark):
    df = spark.createDataFrame([("z", [0.0] * 8), ("n", [None] * 8)], "station string, values array<double>")
    rows = dec.decompose(df, dec.basis_row(dec.fourier_basis(spark, 8, 3)), 2).collect()
    assert all(r["total_var"] == 0 and r["res_mean"] is None and r["res_2"] is None for r in rows)


def test_quality_filter(series, matrix):
    kept = {r["station"] for r in stats.quality_filter(series, ["A"], 1).collect()}
    assert kept == {f"s{i}" for i, row in enumerate(matrix) if i % 3 and np.isnan(row).sum() <= 1}


def test_missing_values_count_as_zero_in_products(spark):
    df = spark.createDataFrame([([1.0, None, 3.0], [2.0, 5.0, None])], "a array<double>, b array<double>")
    row = df.select(vec.dot(F.col("a"), F.col("b")), vec.total(F.col("a")), vec.missing(F.col("a"))).first()
    assert tuple(row) == (2.0, 4.0, 1)


def test_extremes_are_slices_of_the_sorted_fits(series):
    fits = dec.decompose(series, dec.component_basis(series, ["measurement"], K), K, ["measurement"])
    pdf = fits.toPandas().sort_values(["res_3", "station"])
    pieces = dec.fit_extremes(fits, "res_3", ["station"]).toPandas()
    assert sorted(pieces[pieces.piece == 0].station) == sorted(pdf.station[:12])
    assert sorted(pieces[pieces.piece == 1].station) == sorted(pdf.station[-4:])
    assert not (pieces.piece > 1).any()
    low = dec.coefficient_extremes(fits, "coeff_2", "res_2", 0.5, ["station"]).toPandas()
    well = pdf[pdf.res_2 < 0.5].sort_values(["coeff_2", "station"])
    assert sorted(low[low.piece == 0].station) == sorted(well.station[:12])
    assert sorted(low[low.piece == 1].station) == sorted(well.station[-12:])


def test_groups_of_several_columns(series, matrix):
    both = series.withColumn("state", F.when(F.col("year") < 1990, "NY").otherwise("VT"))
    cov = stats.covariance(both, ["state", "measurement"]).toPandas()
    assert len(cov) == 4 * D * (D + 1) // 2
    rows = [i for i in range(40) if i % 3]
    expected = covariance(matrix[rows])
    for row in cov[(cov.state == "NY") & (cov.measurement == "A")].itertuples():
        assert row.cov == pytest.approx(expected[row.i, row.j], abs=1e-9)


def test_covariance_with_large_offsets(spark):
    """Offsets of 1e8 do not cost digits, with and without gaps."""
    rng = np.random.default_rng(21)
    small = rng.normal(size=(400, 5))
    offsets = np.array([1e8, -1e8, 3e8, 0.0, 1.0])
    rows = [("a", [float(x) for x in row]) for row in small + offsets]
    df = spark.createDataFrame(rows, "g string, values array<double>").repartition(7)
    kept = np.array([row for _, row in rows]) - offsets
    expected = np.cov(kept.T, bias=True)
    for r in stats.covariance(df, ["g"]).collect():
        assert r["cov"] == pytest.approx(expected[r["i"], r["j"]], abs=1e-6)


def test_covariance_with_offsets_and_gaps_follows_its_definition(spark):
    from fractions import Fraction

    rng = np.random.default_rng(22)
    data = rng.integers(-50, 50, (60, 4)) + np.array([10**8, -(10**8), 0, 7])
    gaps = rng.random(data.shape) < 0.2
    rows = [[None if g else float(x) for x, g in zip(*pair)] for pair in zip(data, gaps)]
    df = spark.createDataFrame([(row,) for row in rows], "values array<double>")
    mean = lambda v: sum(map(Fraction, v)) / len(v)
    column = lambda i: [int(x) for x, g in zip(data[:, i], gaps[:, i]) if not g]
    for r in stats.covariance(df, []).collect():
        both = ~gaps[:, r["i"]] & ~gaps[:, r["j"]]
        products = [int(a) * int(b) for a, b in zip(data[both, r["i"]], data[both, r["j"]])]
        exact = mean(products) - mean(column(r["i"])) * mean(column(r["j"]))
        assert r["cov"] == pytest.approx(float(exact), rel=1e-9, abs=1e-6)
