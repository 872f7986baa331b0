"""Decomposition of series on a mean and a few basis vectors.

A basis is a table with one row per group of series: key columns, ``mean`` and
``vectors`` (array of arrays, orthonormal).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions import vectors as vec
from seriesloom.functions.arrowtools import groups_of, padded_matrix
from seriesloom.operators.ordered import ecdf, join_groups, rank_slices
from seriesloom.operators.series_stats import day_stats, principal_components
from seriesloom.staging import stage

FOURIER_FUNCTIONS = 9
DENSE_BASIS = 4_000_000  # numbers in all means and vectors together, 32 MB
FIT = "struct<coeffs: array<double>, norm: double, total: double>"


def fourier_basis(spark: SparkSession, days: int, functions: int = FOURIER_FUNCTIONS) -> DataFrame:
    """Constant, sin x, cos x, sin 2x, cos 2x, … on ``days`` points of one period, normalised: ``fn, day, value``."""
    step = F.lit(2.0) * F.pi() / days
    scale = F.sqrt(step / F.pi())
    grid = spark.range(days).select(F.col("id").cast("int").alias("day"), (F.col("id") * step).alias("x"))
    cells = grid.withColumn("fn", F.explode(F.sequence(F.lit(0), F.lit(functions - 1))))
    turns = F.ceil(F.col("fn") / 2)
    wave = F.when(F.col("fn") % 2 == 1, F.sin(turns * F.col("x"))).otherwise(F.cos(turns * F.col("x")))
    value = F.when(F.col("fn") == 0, scale / F.sqrt(F.lit(2.0))).otherwise(wave * scale)
    return cells.select("fn", "day", value.alias("value"))


def gram(basis: DataFrame, shares: DataFrame) -> DataFrame:
    """Inner products of all basis functions: ``f, g, product, present_product``.

    The second one weights every day with ``share``, the part of the series that
    has a value on it; it tells how far gaps disturb the orthogonality.
    """
    left = basis.withColumnsRenamed({"fn": "f", "value": "a"})
    right = basis.withColumnsRenamed({"fn": "g", "value": "b"})
    product = F.col("a") * F.col("b")
    cells = left.join(right, "day").join(shares, "day")
    return cells.groupBy("f", "g").agg(
        F.sum(product).alias("product"), F.sum(product * F.col("share")).alias("present_product")
    )


def basis_row(basis: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Basis functions in long form → one row ``mean`` and ``vectors``.

    ``means`` has ``day, mean``; without it the mean is zero.
    """
    days = basis.where(F.col("fn") == 0).select("day")
    if means is None:
        means = days.withColumn("mean", F.lit(0.0))
    mean = means.agg(F.array_sort(F.collect_list(F.struct("day", F.coalesce("mean", F.lit(0.0)).alias("m")))).alias("cells"))
    ordered = basis.groupBy("fn").agg(F.array_sort(F.collect_list(F.struct("day", "value"))).alias("cells"))
    vectors = ordered.select("fn", F.transform("cells", lambda c: c["value"]).alias("vector"))
    rows = vectors.agg(F.array_sort(F.collect_list(F.struct("fn", "vector"))).alias("rows"))
    mean = mean.select(F.transform("cells", lambda c: c["m"]))
    return rows.select(mean.scalar().alias("mean"), F.transform("rows", lambda r: r["vector"]).alias("vectors"))


def component_basis(series: DataFrame, by: Sequence[str], top: int) -> DataFrame:
    """Mean and first ``top`` principal components of every group."""
    by = list(by)
    means = day_stats(series, by).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("day", F.coalesce("mean", F.lit(0.0)).alias("m")))).alias("cells")
    )
    vectors = principal_components(series, by, top).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("rank", "eigvec"))).alias("rows")
    )
    return join_groups(means, vectors, by).select(
        *by,
        F.transform("cells", lambda c: c["m"]).alias("mean"),
        F.transform("rows", lambda r: r["eigvec"]).alias("vectors"),
    )


def _with_basis(series: DataFrame, basis: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the ``mean`` and ``vectors`` of the series' group; NULL where the group has none."""
    if by:
        return join_groups(series, basis, list(by), "left")
    one = basis.select(F.struct("mean", "vectors")).scalar()
    return series.withColumn("b_", one).select(*series.columns, "b_.mean", "b_.vectors")


def _joined_fit(series: DataFrame, basis: DataFrame, by: Sequence[str]) -> DataFrame:
    """The fit by column expressions, for bases of any size."""
    known = F.transform("values", lambda v: F.when(~F.isnan(v), v))
    deviation = F.transform(vec.minus(F.col("known"), F.col("mean")), lambda v: F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0)))
    rows = _with_basis(series, basis, by).withColumn("known", known).withColumn("r0", deviation)
    coeffs = F.when(F.col("r0").isNotNull(), F.transform("vectors", lambda u: vec.dot(F.col("r0"), u))).alias("coeffs")
    norm, total = vec.square_norm(F.col("r0")).alias("norm"), vec.square_norm(F.col("known")).alias("total")
    fit = F.struct(coeffs, norm, total)
    return rows.select(*series.columns, F.when(F.col("mean").isNotNull() & F.col("values").isNotNull(), fit).alias("fit"))


def _dense_fit(series: DataFrame, bases: dict[tuple, tuple[np.ndarray, np.ndarray]], by: Sequence[str]) -> DataFrame:
    """The fit as one matrix product per Arrow batch and group."""

    @F.arrow_udf(FIT)
    def fit(keys: pa.Array, values: pa.Array) -> pa.Array:
        known = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
        matrix = padded_matrix(values.take(pa.array(known)))
        parts = [column.take(pa.array(known)) for column in keys.flatten()[1:]]
        norms, totals, done = np.zeros(len(values)), np.zeros(len(values)), np.zeros(len(values), dtype=bool)
        fitted = np.zeros((len(values), max((len(vectors) for _, vectors in bases.values()), default=0)))
        sizes = np.zeros(len(values), dtype=np.int64)
        for name, members in groups_of(parts, len(known)):
            if name not in bases:
                continue
            mean, vectors = bases[name]
            width = max(len(mean), matrix.shape[1])
            block = np.full((len(members), width), np.nan)
            block[:, : matrix.shape[1]] = matrix[members]
            rest = block - np.pad(mean, (0, width - len(mean)), constant_values=np.nan)
            rest[np.isnan(rest)] = 0.0
            block[np.isnan(block)] = 0.0
            rows = known[members]
            with np.errstate(over="ignore", invalid="ignore"):
                norms[rows] = np.einsum("ij,ij->i", rest, rest)
                totals[rows] = np.einsum("ij,ij->i", block, block)
                fitted[rows, : len(vectors)] = rest @ np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))).T
            sizes[rows], done[rows] = len(vectors), True
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = fitted[np.arange(fitted.shape[1])[None, :] < sizes[:, None]]
        coeffs = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array(~done))
        return pa.StructArray.from_arrays(
            [coeffs, pa.array(norms, mask=~done), pa.array(totals, mask=~done)], names=["coeffs", "norm", "total"]
        )

    keys = F.struct(F.lit(0).alias("none"), *by)
    return series.withColumn("fit", fit(keys, F.col("values")))


def _fit(series: DataFrame, basis: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``fit``: coefficients, squared length of the deviation from the mean, squared length of the series.

    NaN counts as missing, a NULL key is a group of its own, and a vector that is shorter or longer than the
    basis deviates by zero where only one of them has a day.  Up to ``DENSE_BASIS`` numbers the basis is sent to the
    tasks and applied as matrices; beyond it is joined, with the same result.
    """
    basis = stage(basis, "basis")
    size = basis.agg(F.sum(F.size("mean") * (F.size("vectors") + 1)).alias("numbers")).first()["numbers"] or 0
    if size > DENSE_BASIS:
        return _joined_fit(series, basis, by)
    bases = {
        tuple(row[c] for c in by): (np.array(row["mean"], dtype=float), np.array(row["vectors"], dtype=float).reshape(len(row["vectors"]), -1))
        for row in basis.select(*by, "mean", "vectors").collect()
        if row["mean"] is not None and row["vectors"] is not None
    }
    return _dense_fit(series, bases, by)


def _remaining(k: int) -> Column:
    """Array of the squared lengths without the parts along the first 0, 1, … k vectors; rounding may not take them below zero.

    One pass over the coefficients, so k of them cost k steps; a coefficient that is not there makes the rest NULL.
    """
    steps = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("fit.coeffs", i)) if k else F.array().cast("array<double>")
    start = F.struct(F.col("fit.norm").alias("norm"), F.array(F.col("fit.norm")).alias("rests"))

    def less(state: Column, coefficient: Column) -> Column:
        norm = state["norm"] - coefficient * coefficient
        return F.struct(norm.alias("norm"), F.concat(state["rests"], F.array(norm)).alias("rests"))

    rests = F.aggregate(steps, start, less, lambda state: state["rests"])
    return F.transform(rests, lambda rest: F.when(rest < 0, 0.0).otherwise(rest))


def decompose(series: DataFrame, basis: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Coefficients and relative residual norms of every series on an orthonormal basis.

    r₀ = v − mean, coeff_i = r₀·u_i, r_i = r_{i−1} − coeff_i·u_i.  A missing
    value deviates by zero.  ``total_var`` = ‖v‖², ``res_mean`` = ‖r₀‖² / total_var
    and ``res_i`` = ‖r_i‖² / total_var; NULL when total_var is zero.  The norms
    follow from the coefficients, ‖r_i‖² = ‖r_{i−1}‖² − coeff_i², so no residual
    vector is built.
    """
    fitted = _fit(series, basis, by).withColumn("rests", _remaining(k))
    names = ["res_mean", *[f"res_{i + 1}" for i in range(k)]]
    return fitted.select(
        *series.columns,
        *[F.get("fit.coeffs", F.lit(i)).alias(f"coeff_{i + 1}") for i in range(k)],
        F.col("fit.total").alias("total_var"),
        *[F.try_divide(F.get("rests", F.lit(i)), F.col("fit.total")).alias(name) for i, name in enumerate(names)],
    )


def residual_curve(series: DataFrame, basis: DataFrame, functions: int, by: Sequence[str] = ()) -> DataFrame:
    """Length of what the first i basis functions leave of a series, i = 0 … functions: ``keys…, i, residual``."""
    keys = [c for c in series.columns if c != "values"]
    fitted = _fit(series, basis, by)
    # Outer, because the filter that Spark adds to a plain explode would fit every series twice.
    lengths = fitted.select(*keys, F.transform(_remaining(functions), F.sqrt).alias("lengths"))
    return lengths.select(*keys, F.posexplode_outer("lengths").alias("i", "residual"))


def reconstruct(series: DataFrame, basis: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Approximations mean + Σ coeff_i·u_i with 0 … k vectors: ``keys…, k, approximation``."""
    keys = [c for c in series.columns if c != "values"]
    basis = stage(basis, "basis")
    fitted = _with_basis(_fit(series, basis, by), basis, by)
    terms = [(F.get("fit.coeffs", F.lit(i)), F.get("vectors", F.lit(i))) for i in range(k)]
    steps = accumulate(terms, lambda w, term: vec.add_scaled(w, *term), initial=F.col("mean"))
    return fitted.select(*keys, F.posexplode_outer(F.array(*steps)).alias("k", "approximation"))


def _fitted_once(decomposed: DataFrame) -> DataFrame:
    """The decomposition as a table without the vectors: what filters and ranks it would otherwise run the fit again."""
    return stage(decomposed.drop("values"), "decomposition")


def fit_distributions(decomposed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empirical distributions of coefficients and residuals, in one job: ``column, value`` and the ranks of ``ecdf``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return ecdf(decomposed.select(F.inline_outer(pairs)), "value", ["column"])


def beats_mean(decomposed: DataFrame, stations: DataFrame) -> DataFrame:
    """Series that the mean describes better than zero does, with their station's columns."""
    return _fitted_once(decomposed).where(F.col("res_mean") < 1).join(stations, "station", "left")


def fit_extremes(decomposed: DataFrame, column: str, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Best 12, worst 4, and two bands of bad fits (ranks 501–504 and 1001–1004 from the end) by a residual."""
    slices = [(0, 12), (-4, None), (-504, -500), (-1004, -1000)]  # fixed values: the ranks shown
    return rank_slices(_fitted_once(decomposed), [column, *ties], slices, by)


def coefficient_extremes(
    decomposed: DataFrame, coefficient: str, residual: str, limit: float, ties: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Among well-fitted series the 12 lowest and the 12 highest by a coefficient."""
    fitting = _fitted_once(decomposed).where(F.col(residual) < limit)
    return rank_slices(fitting, [coefficient, *ties], [(0, 12), (-12, None)], by)
