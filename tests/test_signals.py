import numpy as np
import pandas as pd
import pytest

from seriesloom.operators import smoothing, spacetime


def smooth_by_force(signal, order, std, edges):
    half, weights, out = order // 2, smoothing.gaussian_window(order, std), []
    for i in range(len(signal)):
        num = den = 0.0
        for o in range(-half, half + 1):
            inside = 0 <= i + o < len(signal)
            v = signal[i + o] if inside else (0.0 if edges == "zero" else np.nan)
            if not np.isnan(v):
                num, den = num + weights[o + half] * v, den + weights[o + half]
        out.append(num / den if den else np.nan)
    return np.array(out)


def test_window_is_normalised_and_symmetric():
    w = smoothing.gaussian_window()
    assert len(w) == 101 and w.sum() == pytest.approx(1) and np.allclose(w, w[::-1])
    assert w[50] / w[30] == pytest.approx(np.exp(0.5))


@pytest.mark.parametrize("edges", smoothing.EDGES)
@pytest.mark.parametrize("length", [7, 64, 512])
def test_smoothing_equals_brute_force(spark, edges, length):
    rng = np.random.default_rng(length)
    signals = {"a": rng.normal(size=150), "b": rng.normal(size=41)}
    signals["a"][20:75] = np.nan  # a gap longer than the window
    rows = [(g, i, float(v)) for g, s in signals.items() for i, v in enumerate(s) if not np.isnan(v)]
    df = spark.createDataFrame(rows, "g string, at long, v double").repartition(6)
    got = smoothing.smooth_signal(df, ["g"], "at", "v", 31, 6.0, edges, length).toPandas()
    for g, s in signals.items():
        ours = got[got.g == g].sort_values("at")
        assert ours["at"].tolist() == list(range(len(s)))
        assert np.allclose(ours.smooth.astype(float), smooth_by_force(s, 31, 6.0, edges), equal_nan=True)


def test_rows_of_a_station_are_joined_in_year_order(spark):
    rng = np.random.default_rng(2)
    days, years = 20, [1950, 1951, 1960, 1961, 1990]
    rows, flat = [], {}
    for station in ("s1", "s2"):
        values = rng.normal(size=(len(years), days))
        values[1, 3:9] = np.nan
        flat[station] = values.ravel()
        for y, v in zip(years, values):
            rows.append((station, "PRCP", y, [None if np.isnan(x) else float(x) for x in v], "NY"))
    df = spark.createDataFrame(rows, "station string, measurement string, year int, values array<double>, state string")
    both = smoothing.append_smoothed(df.repartition(4), days, order=51, std=10.0)
    assert both.columns == df.columns and both.count() == 2 * len(rows)
    smooth = both.where("measurement = 'smooth_PRCP'").toPandas()
    for station, signal in flat.items():
        ours = smooth[smooth.station == station].sort_values("year")
        assert ours.year.tolist() == years and set(ours.state) == {"NY"}
        got = np.concatenate([np.array(v, dtype=float) for v in ours["values"]])
        assert np.allclose(got, smooth_by_force(signal, 51, 10.0, "renormalise"))


def test_even_windows_and_unknown_edges_are_refused(spark):
    df = spark.createDataFrame([("a", 0, 1.0)], "g string, at long, v double")
    with pytest.raises(ValueError):
        smoothing.smooth_signal(df, ["g"], "at", "v", 100, 20.0)
    with pytest.raises(ValueError):
        smoothing.smooth_signal(df, ["g"], "at", "v", edges="wrap")


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(5)
    table = rng.normal(3, 1, (9, 14)) + rng.normal(size=(9, 1)) * 3 + rng.normal(size=(1, 14))
    table[rng.random(table.shape) < 0.3] = np.nan
    frame = pd.DataFrame(table, index=range(1950, 1959), columns=[f"s{i}" for i in range(14)])
    rows = [(y, s, float(v)) for y, row in frame.iterrows() for s, v in row.items() if not np.isnan(v)]
    return frame, spark.createDataFrame(rows, "year int, station string, v double").repartition(5)


def rms(table):
    return np.sqrt(np.nanmean(table**2))


def test_effects_of_year_and_station(cells):
    frame, df = cells
    t = frame.to_numpy()
    row = spacetime.rms_effects(df).first()
    assert row["total"] == pytest.approx(rms(t))
    assert row["minus_year"] == pytest.approx(rms(t - np.nanmean(t, axis=1, keepdims=True)))
    assert row["station_reduction"] == pytest.approx(rms(t) - rms(t - np.nanmean(t, axis=0)))


def test_two_way_centering(cells):
    frame, df = cells
    centering = spacetime.TwoWayCentering(df).run(5)
    errors = {(r["round"], r["step"]): r["rms"] for r in centering.trace().collect()}
    t, total = frame.to_numpy().copy(), np.zeros(len(frame))
    assert errors[-1, "start"] == pytest.approx(rms(t))
    for i in range(5):
        by_year = np.nanmean(t, axis=1)
        t, total = t - by_year[:, None], total + by_year
        assert errors[i, "year"] == pytest.approx(rms(t))
        t = t - np.nanmean(t, axis=0)
        assert errors[i, "station"] == pytest.approx(rms(t))
    effects = {r["year"]: (r["effect"], r["last"]) for r in centering.year_effect().collect()}
    for year, effect, last in zip(frame.index, total, by_year):
        assert effects[year] == pytest.approx((effect, last), abs=1e-9)


def test_missing_fractions(cells):
    frame, df = cells
    for of, over, axis in (("station", "year", 0), ("year", "station", 1)):
        got = {r[of]: r["missing"] for r in spacetime.missing_fraction(df, of, over).collect()}
        assert got == pytest.approx(frame.isna().mean(axis=axis).to_dict())


def test_markers(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("c", 6.0)], "station string, v double")
    rows = {r["station"]: (r["n"], r["colour"], r["radius"]) for r in spacetime.station_markers(df, ["station"], "v").collect()}
    assert rows == {"a": (2, 0.0, 1697), "b": (1, 1.0, 1200), "c": (1, 0.5, 1200)}


def test_half_steps_do_not_exchange_cells(spark, cells):
    """Without broadcasts: cells are read where they lie; what is exchanged are partial sums."""
    plans = []

    class Watched(spacetime.TwoWayCentering):
        def _moments(self, side):
            found = super()._moments(side)
            plans.append(found._jdf.queryExecution().executedPlan().toString())
            return found

    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        Watched(cells[1], held_stations=0).run(2)
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert len(plans) == 4
    for text in plans:
        assert text.index("Exchange hashpartitioning") < text.index("partial_avg") < text.index("Generate explode")
        assert not any("Exchange" in line for line in above_cells(text))
    assert all("Bucketed: true" in text for text in plans[2:])


def above_cells(plan):
    """The nodes of a plan from the explode down to the scan of the arrays of cells."""
    path, depths = [], []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        while depths and depths[-1] >= depth:
            depths.pop()
            path.pop()
        depths.append(depth)
        path.append(line)
        if "FileScan" in line and "array<struct<at:int,v:double>>" in line:
            start = max(i for i, node in enumerate(path) if "Generate explode" in node)
            return path[start:]
    raise AssertionError(plan)


@pytest.mark.parametrize("options", [{"chunk": 2}, {"held": 0}, {"chunk": 3, "held": 3, "held_stations": 0}])
def test_centering_in_small_chunks_and_with_many_years(cells, options):
    frame, df = cells
    usual, other = (spacetime.TwoWayCentering(df, **o).run(3) for o in ({}, options))
    for one in ("trace", "year_effect"):
        a, b = (sorted(map(tuple, getattr(x, one)().collect()), key=repr) for x in (usual, other))
        assert [x[:-1] if one == "trace" else x[:1] for x in a] == [x[:-1] if one == "trace" else x[:1] for x in b]
        assert np.allclose([x[-1] for x in a], [x[-1] for x in b])


def test_centering_of_repeated_and_missing_cells(spark):
    rows = [(2000, "a", 1.0), (2000, "a", 1.0), (2000, "a", 4.0), (2001, "b", 2.0), (2001, "a", 7.0), (None, "a", 5.0), (2000, None, 5.0), (2000, "b", None)]
    df = spark.createDataFrame(rows, "year int, station string, v double")
    trace = {(r["round"], r["step"]): r["rms"] for r in spacetime.TwoWayCentering(df).run(1).trace().collect()}
    known = np.array([1, 1, 4, 2, 7.0])
    years, stations = np.array([0, 0, 0, 1, 1]), np.array([0, 0, 0, 1, 0])
    assert trace[-1, "start"] == pytest.approx(np.sqrt((known**2).mean()))
    for step, groups in (("year", years), ("station", stations)):
        known = known - np.array([known[groups == g].mean() for g in groups])
        assert trace[0, step] == pytest.approx(np.sqrt((known**2).mean()))


def test_tables_of_the_centering_are_gone_afterwards(spark, cells):
    before = {t.name for t in spark.catalog.listTables()}
    spacetime.TwoWayCentering(cells[1]).run(1)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_long_windows_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    signal = rng.normal(size=23_000) + 1e3
    signal[4000:11_000] = np.nan
    signal[rng.random(len(signal)) < 0.2] = np.nan
    rows = [(i, float(v)) for i, v in enumerate(signal) if not np.isnan(v)]
    df = spark.createDataFrame([("a", *r) for r in rows], "g string, at long, v double")
    order, std = 10_001, 1500.0
    got = smoothing.smooth_signal(df, ["g"], "at", "v", order, std).toPandas().sort_values("at").smooth.to_numpy(float)
    half, weights = order // 2, smoothing.gaussian_window(order, std)
    for i in [0, 1, 2500, 5000, 7500, 9000, 10_999, 15_000, 22_999, *rng.integers(0, len(signal), 40)]:
        low, high = max(0, i - half), min(len(signal), i + half + 1)
        part, w = signal[low:high], weights[low - i + half : high - i + half]
        there = ~np.isnan(part)
        assert got[i] == pytest.approx((part[there] * w[there]).sum() / w[there].sum(), rel=1e-9)


def test_far_tails_of_narrow_windows_are_summed_directly():
    """Deep in a gap all present weights are tiny; rounding of the transforms must not show."""
    weights = smoothing.gaussian_window(101, 2.0)
    rows = np.full((3, 400), np.nan)
    rows[0, :60], rows[0, 130:] = 5.0, -2.0
    rows[1] = np.arange(400) * 1e6
    got = smoothing.smoothed_rows(rows, weights)
    for r in range(3):
        for at in range(300):
            part = rows[r, at : at + 101]
            there = ~np.isnan(part)
            if not there.any():
                assert np.isnan(got[r, at])
            else:
                scaled = weights[there] / weights[there].max()
                assert got[r, at] == pytest.approx((part[there] * scaled).sum() / scaled.sum(), rel=1e-9)
