"""Statistics, principal components and decomposition of the series."""

from __future__ import annotations

from math import pi

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seriesloom.operators import blockmatrix, ordered
from seriesloom.operators import decompose as dec
from seriesloom.operators import series_stats as stats
from seriesloom.operators.profile import scaled_units
from seriesloom.plans.profile import near
from seriesloom.plans.registry import query
from seriesloom.plans.views import DAYS, SERIES_LONG_SQL, r6, series, table
from seriesloom.staging import scratch_path, stage

BY = ["measurement"]
TENTHS = ["M0", "M1", "M2", "M3"]


@query(
    "series_value_stats",
    f"""WITH {SERIES_LONG_SQL} SELECT measurement, count(v) AS n, round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std,
        round(quantile_cont(v, 0.001), 6) + 0.0 AS low1000, round(quantile_cont(v, 0.01), 6) + 0.0 AS low100,
        round(quantile_cont(v, 0.99), 6) + 0.0 AS high100, round(quantile_cont(v, 0.999), 6) + 0.0 AS high1000
        FROM series_long GROUP BY 1""",
)
def series_value_stats(spark, folder):
    found = stats.value_stats(series(spark, folder), BY)
    return found.select("measurement", "n", *[r6(F.col(c)).alias(c) for c in found.columns if c not in ("measurement", "n")])


@query(
    "series_value_sample",
    f"WITH {SERIES_LONG_SQL} SELECT measurement, count(v) AS total, 0 AS strangers, true AS within FROM series_long GROUP BY 1",
)
def series_value_sample(spark, folder):
    sample = stats.value_sample(series(spark, folder), BY, 0.05, seed=7).groupBy("measurement", "v").agg(F.count(F.lit(1)).alias("n"))
    values = stats.explode_days(series(spark, folder), BY).where("v IS NOT NULL").groupBy("measurement", "v").agg(F.count(F.lit(1)).alias("there"))
    both = values.join(sample, ["measurement", "v"], "full")
    more = F.greatest(F.coalesce("n", F.lit(0)) - F.coalesce("there", F.lit(0)), F.lit(0))
    found = both.groupBy("measurement").agg(F.sum("there").alias("total"), F.sum(more).alias("strangers"), F.sum("n").alias("n"))
    within = near(F.col("n"), F.col("total") * 0.05, F.sqrt(F.col("total") * (0.05 * 0.95)))
    return found.select("measurement", "total", "strangers", within.alias("within"))


@query(
    "series_value_draw",
    f"""WITH {SERIES_LONG_SQL} SELECT measurement, draw, station, day, round(v, 6) + 0.0 AS v FROM (
        SELECT *, row_number() OVER (PARTITION BY measurement ORDER BY md5(concat_ws('|', '7', station::VARCHAR, day::VARCHAR)), station, day)::INTEGER AS draw
        FROM series_long WHERE v IS NOT NULL) WHERE draw <= 200""",
)
def series_value_draw(spark, folder):
    """200 values of every measurement, the same for any layout."""
    drawn = stats.value_draw(series(spark, folder), BY, ["station"], 200, seed=7)
    return drawn.select("measurement", "draw", "station", "day", r6(F.col("v")).alias("v"))


@query(
    "missing_per_row_draw",
    f"""WITH {SERIES_LONG_SQL}, rows AS (SELECT measurement, station, (count(*) - count(v))::INTEGER AS missing FROM series_long GROUP BY 1, 2)
        SELECT measurement, draw, station, missing FROM (
        SELECT *, row_number() OVER (PARTITION BY measurement ORDER BY md5(concat_ws('|', '7', station::VARCHAR)), station)::INTEGER AS draw FROM rows)
        WHERE draw <= 30""",
)
def missing_per_row_draw(spark, folder):
    """The number of missing values of 30 rows of every measurement."""
    return stats.missing_draw(series(spark, folder), BY, ["station"], 30, seed=7).select("measurement", "draw", "station", "missing")


@query(
    "series_day_stats",
    f"""WITH {SERIES_LONG_SQL} SELECT measurement, day, round(sum(v), 6) + 0.0 AS e, count(v) AS ne, round(avg(v), 6) + 0.0 AS mean
        FROM series_long GROUP BY 1, 2""",
)
def series_day_stats(spark, folder):
    days = stats.day_stats(series(spark, folder), BY)
    return days.withColumns({"e": r6(F.col("e")), "mean": r6(F.col("mean"))})


_MOMENTS_SQL = f"""{SERIES_LONG_SQL}, moments AS (
  SELECT a.measurement, a.day AS i, b.day AS j, coalesce(sum(a.v * b.v), 0) AS o, count(a.v * b.v) AS no
  FROM series_long a JOIN series_long b ON a.station = b.station AND a.day <= b.day GROUP BY 1, 2, 3),
means AS (SELECT measurement, day, avg(v) AS mean FROM series_long GROUP BY 1, 2)"""


@query(
    "series_second_moments",
    f"WITH {_MOMENTS_SQL} SELECT measurement, i, j, round(o, 6) + 0.0 AS o, no FROM moments",
)
def series_second_moments(spark, folder):
    moments = stats.second_moments(series(spark, folder), BY)
    return moments.withColumn("o", r6(F.col("o")))


@query(
    "series_cov",
    f"""WITH {_MOMENTS_SQL} SELECT m.measurement, i, j, round(o / nullif(no, 0) - a.mean * b.mean, 6) + 0.0 AS cov FROM moments m
        JOIN means a ON a.measurement = m.measurement AND a.day = i JOIN means b ON b.measurement = m.measurement AND b.day = j""",
)
def series_cov(spark, folder):
    cov = stats.covariance(series(spark, folder), BY)
    return cov.withColumn("cov", r6(F.col("cov")))


_VAR_SQL = f"""{SERIES_LONG_SQL}, var AS (
  SELECT measurement, day, avg(v * v) - avg(v) * avg(v) AS var, avg(v) AS mean FROM series_long GROUP BY 1, 2)"""


@query("series_var", f"WITH {_VAR_SQL} SELECT measurement, day, round(var, 6) + 0.0 AS var FROM var")
def series_var(spark, folder):
    var = stats.variances(series(spark, folder), BY)
    return var.withColumn("var", r6(F.col("var")))


@query(
    "mean_std_curves",
    f"""WITH {_VAR_SQL}, scaled AS (SELECT *, sqrt(greatest(var, 0)) AS std,
          CASE WHEN measurement IN ('M0', 'M1', 'M2', 'M3') THEN 10 ELSE 1 END AS scale FROM var)
        SELECT measurement, day, round((mean - std) / scale, 6) + 0.0 AS mean_minus_std, round(mean / scale, 6) + 0.0 AS mean,
               round((mean + std) / scale, 6) + 0.0 AS mean_plus_std FROM scaled""",
)
def mean_std_curves(spark, folder):
    scale = F.lit(1.0) / scaled_units(F.lit(1.0), F.col("measurement"), TENTHS)
    curves = stats.mean_std_curves(series(spark, folder), BY, scale)
    return curves.withColumns({c: r6(F.col(c)) for c in ("mean_minus_std", "mean", "mean_plus_std")})


@query(
    "var_distance",
    f"""WITH {_VAR_SQL} SELECT b.measurement, round(sum(abs(a.var - b.var)), 6) + 0.0 AS distance
        FROM var a JOIN var b ON a.day = b.day WHERE a.measurement = 'M0' GROUP BY 1""",
)
def var_distance(spark, folder):
    distances = stats.variance_distance(series(spark, folder), "measurement", "M0")
    return distances.withColumn("distance", r6(F.col("distance")))


_COV_SQL = f"""{_MOMENTS_SQL}, cov AS (
  SELECT m.measurement, i, j, coalesce(o / nullif(no, 0) - a.mean * b.mean, 0) AS cov FROM moments m
  JOIN means a ON a.measurement = m.measurement AND a.day = i JOIN means b ON b.measurement = m.measurement AND b.day = j)"""


@query(
    "pca_eig",
    f"""WITH {_COV_SQL} SELECT measurement, {DAYS} AS components, round(sum(CASE WHEN i = j THEN cov ELSE 0 END), 6) + 0.0 AS trace,
        round(sum(CASE WHEN i = j THEN cov * cov ELSE 2 * cov * cov END), 6) + 0.0 AS squares FROM cov GROUP BY 1""",
)
def pca_eig(spark, folder):
    """The eigenvalues add up to the trace of the covariance, their squares to those of its cells."""
    components = stats.principal_components(series(spark, folder), BY)
    squares = F.sum(F.col("eigval") * F.col("eigval"))
    return components.groupBy("measurement").agg(
        F.count(F.lit(1)).alias("components"), r6(F.sum("eigval")).alias("trace"), r6(squares).alias("squares")
    )


@query(
    "eigvec_long",
    f"""WITH {SERIES_LONG_SQL} SELECT DISTINCT measurement, unnest([1, 2, 3, 4]) AS rank, {DAYS} AS days, 1.0::DOUBLE AS length,
        0.0::DOUBLE AS overlap FROM series_long""",
)
def eigvec_long(spark, folder):
    """The vectors have unit length, and each is orthogonal to the one before."""
    long = stage(stats.eigenvector_table(stats.principal_components(series(spark, folder), BY, 4), BY, 4), "eigenvectors")
    before = long.select("measurement", (F.col("rank") + 1).alias("rank"), "day", F.col("value").alias("previous"))
    both = long.join(before, ["measurement", "rank", "day"], "left")
    overlap = F.abs(F.sum(F.col("value") * F.coalesce("previous", F.lit(0.0))))
    return both.groupBy("measurement", "rank").agg(
        F.count(F.lit(1)).alias("days"), r6(F.sum(F.col("value") * F.col("value"))).alias("length"), (r6(overlap) + 0.0).alias("overlap")
    )


@query(
    "variance_explained",
    f"""WITH {SERIES_LONG_SQL} SELECT DISTINCT measurement, {DAYS} + 1 AS ranks, 0.0::DOUBLE AS at_none, 1.0::DOUBLE AS at_all, true AS slowing
        FROM series_long""",
)
def variance_explained(spark, folder):
    """The shares go from 0 to 1 in steps that never grow."""
    components = stats.principal_components(series(spark, folder), BY)
    shares = ordered.cumulative_share(components, "eigval", "rank", BY)
    rising = F.array_sort(F.collect_list(F.struct("rank", "share")))
    curve = shares.groupBy("measurement").agg(F.transform(rising, lambda s: s["share"]).alias("s"))
    steps = F.zip_with(F.slice("s", 2, DAYS), F.slice("s", 1, DAYS), lambda b, a: b - a)
    slowing = F.forall(F.zip_with(F.slice(steps, 2, DAYS - 1), F.slice(steps, 1, DAYS - 1), lambda b, a: b <= a + 1e-12), lambda ok: ok)
    return curve.select(
        "measurement", F.size("s").alias("ranks"), F.get("s", F.lit(0)).alias("at_none"), r6(F.element_at("s", -1)).alias("at_all"), slowing.alias("slowing")
    )


# -------------------------------------------------------------------- Fourier

_FOURIER_SQL = f"""fourier AS (
  SELECT fn::INTEGER AS fn, day::INTEGER AS day, CASE WHEN fn = 0 THEN sqrt(2 * {pi} / {DAYS} / {pi}) / sqrt(2)
    WHEN fn % 2 = 1 THEN sqrt(2 * {pi} / {DAYS} / {pi}) * sin(((fn + 1) // 2) * day * 2 * {pi} / {DAYS})
    ELSE sqrt(2 * {pi} / {DAYS} / {pi}) * cos((fn // 2) * day * 2 * {pi} / {DAYS}) END AS value
  FROM range(9) AS f(fn), range({DAYS}) AS g(day))"""


def _fit_sql(mean: str) -> str:
    """Fit of every series, with the given mean of a day, by 0 … 9 Fourier functions."""
    return f"""{SERIES_LONG_SQL}, {_FOURIER_SQL},
mu AS (SELECT day, {mean} AS m FROM series_long GROUP BY 1),
centred AS (SELECT station, day, m, coalesce(v - m, 0) AS r FROM series_long JOIN mu USING (day)),
coeffs AS (SELECT station, fn, sum(r * value) AS c FROM centred JOIN fourier USING (day) GROUP BY 1, 2),
norms AS (SELECT station, sum(v * v) AS total FROM series_long GROUP BY 1),
terms AS (SELECT station, fn, day, c * value AS term FROM coeffs JOIN fourier USING (fn)),
partial AS (SELECT station, fn + 1 AS k, day, sum(term) OVER (PARTITION BY station, day ORDER BY fn) AS s FROM terms
  UNION ALL SELECT station, 0, day, 0 FROM centred),
approx AS (SELECT p.station, p.k, p.day, m + s AS w, r - s AS rest FROM partial p JOIN centred USING (station, day)),
residuals AS (SELECT station, k, sum(rest * rest) AS res FROM approx GROUP BY 1, 2)"""


_FIT_SQL = _fit_sql("avg(v)")


def _fourier(spark, given):
    return dec.basis_row(dec.fourier_basis(spark, DAYS), stats.day_stats(given, []))


@query(
    "fourier_gram",
    f"""WITH {SERIES_LONG_SQL}, {_FOURIER_SQL}, shares AS (SELECT day, count(v) / count(*) AS share FROM series_long GROUP BY 1)
        SELECT a.fn AS f, b.fn AS g, round(sum(a.value * b.value), 6) + 0.0 AS product,
               round(sum(a.value * b.value * share), 6) + 0.0 AS present_product
        FROM fourier a JOIN fourier b USING (day) JOIN shares USING (day) GROUP BY 1, 2""",
)
def fourier_gram(spark, folder):
    # Next to the plain inner products: those over the readings that the series really have.
    presence = F.avg(F.col("v").isNotNull().cast("double")).alias("share")
    shares = stats.explode_days(series(spark, folder), BY).groupBy("day").agg(presence)
    products = dec.gram(dec.fourier_basis(spark, DAYS), shares)
    return products.select("f", "g", *[(r6(F.col(c)) + 0.0).alias(c) for c in ("product", "present_product")])


@query(
    "fourier_residuals",
    f"WITH {_fit_sql('0.0::DOUBLE')} SELECT station, k::INTEGER AS i, round(sqrt(res), 6) + 0.0 AS residual FROM residuals",
)
def fourier_residuals(spark, folder):
    curve = dec.residual_curve(series(spark, folder), dec.basis_row(dec.fourier_basis(spark, DAYS)), 9)
    return curve.select("station", "i", r6(F.col("residual")).alias("residual"))


_DECOMPOSED_SQL = f"""{_FIT_SQL}, decomposed AS (SELECT station, total AS total_var, res_mean, coeff_1, coeff_2, res_1, res_2, res_3
  FROM norms JOIN (SELECT station, max(c) FILTER (fn = 0) AS coeff_1, max(c) FILTER (fn = 1) AS coeff_2 FROM coeffs GROUP BY 1) USING (station)
  JOIN (SELECT station, max(res / total) FILTER (k = 0) AS res_mean, max(res / total) FILTER (k = 1) AS res_1,
          max(res / total) FILTER (k = 2) AS res_2, max(res / total) FILTER (k = 3) AS res_3
        FROM residuals JOIN norms USING (station) GROUP BY 1) USING (station))"""
_DECOMPOSED = ["coeff_1", "coeff_2", "total_var", "res_mean", "res_1", "res_2", "res_3"]


def _decomposed(spark, folder):
    given = series(spark, folder)
    rows = dec.decompose(given, _fourier(spark, given), 3)
    return rows.select("station", "measurement", *_DECOMPOSED)


def _rounded(df, *keys):
    return df.select(*keys, *[r6(F.col(c)).alias(c) for c in _DECOMPOSED])


_ROUNDED_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in _DECOMPOSED)


@query("decompose_fixed_basis", f"WITH {_DECOMPOSED_SQL} SELECT station, {_ROUNDED_SQL} FROM decomposed")
def decompose_fixed_basis(spark, folder):
    return _rounded(_decomposed(spark, folder), "station")


@query(
    "decompose_pca",
    f"""WITH {SERIES_LONG_SQL}, means AS (SELECT measurement, day, coalesce(avg(v), 0) AS mean FROM series_long GROUP BY 1, 2)
        SELECT station, round(sum(v * v), 6) AS total_var, round(sum(coalesce(v - mean, 0) * coalesce(v - mean, 0)) / sum(v * v), 6) AS res_mean,
        round(sum(coalesce(v - mean, 0) * coalesce(v - mean, 0)), 6) AS squared_coefficients, 0.0::DOUBLE AS res_all
        FROM series_long JOIN means USING (measurement, day) GROUP BY 1""",
)
def decompose_pca(spark, folder):
    """On all components the squared coefficients add up to the squared deviation from the mean, and nothing is left."""
    given = series(spark, folder)
    fitted = stage(dec.decompose(given, dec.component_basis(given, BY, DAYS), DAYS, BY), "fitted")
    squares = F.aggregate(F.array(*[F.col(f"coeff_{i + 1}") for i in range(DAYS)]), F.lit(0.0), lambda total, c: total + c * c)
    return fitted.select(
        "station", r6(F.col("total_var")).alias("total_var"), r6(F.col("res_mean")).alias("res_mean"),
        r6(squares).alias("squared_coefficients"), (r6(F.col(f"res_{DAYS}")) + 0.0).alias("res_all"),
    )


@query(
    "decompose_filter",
    f"""WITH {_DECOMPOSED_SQL} SELECT d.station, c_name, {_ROUNDED_SQL} FROM decomposed d
        LEFT JOIN customer ON c_custkey = d.station WHERE res_mean < 1""",
)
def decompose_filter(spark, folder):
    stations = table(spark, folder, "customer").select(F.col("c_custkey").alias("station"), "c_name")
    kept = dec.beats_mean(_decomposed(spark, folder), stations)
    path = scratch_path(spark, "decomposition")
    kept.write.mode("overwrite").parquet(path)
    return _rounded(spark.read.parquet(path), "station", "c_name")


@query(
    "reconstruct",
    f"WITH {_FIT_SQL} SELECT station, k::INTEGER AS k, day, round(w, 6) + 0.0 AS w FROM approx WHERE k <= 3",
)
def reconstruct(spark, folder):
    given = series(spark, folder)
    rows = dec.reconstruct(given, _fourier(spark, given), 3)
    long = rows.select("station", "k", F.posexplode("approximation").alias("day", "w"))
    return long.withColumn("w", r6(F.col("w")))


@query(
    "fit_extremes",
    f"""WITH {_DECOMPOSED_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY res_3, station) AS up,
          row_number() OVER (ORDER BY res_3 DESC, station DESC) AS down FROM decomposed)
        SELECT piece, station, {_ROUNDED_SQL} FROM ranked,
        (VALUES (0, 1, 12, 0, 0), (1, 0, 0, 1, 4), (2, 0, 0, 501, 504), (3, 0, 0, 1001, 1004)) AS s(piece, u1, u2, d1, d2)
        WHERE up BETWEEN u1 AND u2 OR down BETWEEN d1 AND d2""",
)
def fit_extremes(spark, folder):
    pieces = dec.fit_extremes(_decomposed(spark, folder), "res_3", ["station"])
    return _rounded(pieces, "piece", "station")


@query(
    "coefficient_extremes",
    f"""WITH {_DECOMPOSED_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY coeff_2, station) AS up,
          row_number() OVER (ORDER BY coeff_2 DESC, station DESC) AS down FROM decomposed WHERE res_2 < 0.9)
        SELECT piece, station, {_ROUNDED_SQL} FROM ranked, (VALUES (0, 1, 12, 0, 0), (1, 0, 0, 1, 12)) AS s(piece, u1, u2, d1, d2)
        WHERE up BETWEEN u1 AND u2 OR down BETWEEN d1 AND d2""",
)
def coefficient_extremes(spark, folder):
    pieces = dec.coefficient_extremes(_decomposed(spark, folder), "coeff_2", "res_2", 0.9, ["station"])
    return _rounded(pieces, "piece", "station")


_CURVES = ["coeff_1", "coeff_2", "res_mean", "res_1", "res_2", "res_3"]


@query(
    "fit_cdf",
    f"""WITH {_DECOMPOSED_SQL}, long AS ({' UNION ALL '.join(f"SELECT '{c}' AS name, round({c}, 6) AS value FROM decomposed" for c in _CURVES)}),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY value) AS rn, count(*) OVER (PARTITION BY name) AS n FROM long WHERE value IS NOT NULL)
        SELECT name, value, min(rn) AS first_rank, max(rn) AS last_rank, round(min(rn) / (any_value(n) + 1), 6) + 0.0 AS p_first,
               round(max(rn) / (any_value(n) + 1), 6) + 0.0 AS p_last FROM ranked GROUP BY 1, 2""",
)
def fit_cdf(spark, folder):
    curves = dec.fit_distributions(_rounded(_decomposed(spark, folder), "station"), _CURVES)
    return curves.withColumnRenamed("column", "name").withColumns({c: r6(F.col(c)) for c in ("p_first", "p_last")})


# ------------------------------------------------------- matrices of blocks

_FILLED_SQL = f"""{SERIES_LONG_SQL}, filled AS (SELECT station, day, coalesce(v, 0) AS v FROM series_long),
  vectors AS (SELECT station AS i, list(v ORDER BY day) AS x FROM filled GROUP BY 1)"""


def _series_matrix(spark, folder):
    """The readings as a matrix of stations and days, missing ones as 0."""
    numbered = series(spark, folder).select(F.col("station").alias("i"), F.transform("values", lambda v: F.coalesce(v, F.lit(0.0))).alias("values"))
    return blockmatrix.from_rows(numbered, "i", "values", DAYS).staged()


def _row_figures(rows, columns, values):
    """Of every row of a rectangle its number, sum, largest element and element on the diagonal, if that is inside."""
    at = np.minimum(np.searchsorted(columns, rows), len(columns) - 1)
    own = pa.array(values[np.arange(len(rows)), at], mask=columns[at] != rows)
    return [pa.array(rows), pa.array(values.sum(axis=1)), pa.array(values.max(axis=1)), own]


@query(
    "matrix_gram",
    f"""WITH {_FILLED_SQL} SELECT a.i AS "row", round(sum(list_inner_product(a.x, b.x)), 6) + 0.0 AS total,
        round(max(list_inner_product(a.x, b.x)), 6) + 0.0 AS largest, round(sum(list_inner_product(a.x, b.x)) FILTER (b.i = a.i), 6) AS own
        FROM vectors a, vectors b GROUP BY 1""",
)
def matrix_gram(spark, folder):
    """A·Aᵀ of all series, where their blocks meet; of each row its sum, largest element and diagonal."""
    a = _series_matrix(spark, folder)
    cells = (a @ a.transpose()).cells(_row_figures, "row long, total double, largest double, own double")
    found = cells.groupBy("row").agg(F.sum("total").alias("total"), F.max("largest").alias("largest"), F.max("own").alias("own"))
    return found.select("row", *(r6(F.col(c)).alias(c) for c in ("total", "largest", "own")))


@query(
    "matrix_reshape",
    f"""WITH {_FILLED_SQL}, placed AS (SELECT station * {DAYS} + day AS p, v FROM filled UNION ALL
          SELECT (station + (SELECT count(*) FROM vectors)) * {DAYS} + day, 2 * v FROM filled)
        SELECT p // 40 AS "row", p % 40 AS "column", round(v, 6) + 0.0 AS value FROM placed""",
)
def matrix_reshape(spark, folder):
    """The matrix above its double, under rows of 40 elements; the last one may be shorter."""
    a = _series_matrix(spark, folder)
    double = blockmatrix.BlockMatrix(a.blocks.withColumn("values", F.transform("values", lambda v: v * 2)), a.rows, a.columns, a.block)
    both = a.below(double)
    elements = both.rows * both.columns
    cells = both.reshape(-(-elements // 40), 40, rest=0.0).cells()
    return cells.where(F.col("row") * 40 + F.col("column") < elements).withColumn("value", r6(F.col("value")))


@query(
    "matrix_outer",
    f"""WITH {_FILLED_SQL}, sums AS (SELECT i, list_sum(x) AS s FROM vectors), days AS (SELECT day, sum(v) AS s FROM filled GROUP BY 1)
        SELECT i AS "row", round(sum(sums.s * days.s), 6) + 0.0 AS total, round(sum(sums.s * days.s * (day + 1)), 6) + 0.0 AS weighted FROM sums, days GROUP BY 1""",
)
def matrix_outer(spark, folder):
    """Outer product of the sums of the rows and of the columns, both from products with ones."""
    a = _series_matrix(spark, folder)

    def ones(n):
        return blockmatrix.from_rows(spark.range(n).select("id", F.array(F.lit(1.0)).alias("one")), "id", "one", 1)

    rows, days = (a @ ones(a.columns)).staged(), (a.transpose() @ ones(a.rows)).staged()
    cells = blockmatrix.outer(rows, days).cells()
    found = cells.groupBy("row").agg(F.sum("value").alias("total"), F.sum(F.col("value") * (F.col("column") + 1)).alias("weighted"))
    return found.select("row", r6(F.col("total")).alias("total"), r6(F.col("weighted")).alias("weighted"))
