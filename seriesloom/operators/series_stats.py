"""Statistics of long vectors with missing values, per group of series.

A series row has key columns and ``values array<double>``, NULL for missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesloom.functions import vectors as vec
from seriesloom.functions.arrowtools import groups_of, list_column, matrix_of
from seriesloom.operators.folding import bounded_sample
from seriesloom.operators.ordered import exact_quantiles, join_groups
from seriesloom.staging import stage

MERGE_PARTS = 32  # salted parts in which the sums of one row are added first
HELD_BYTES = 128 << 20  # partial matrices a task keeps before it hands them on


def explode_days(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per series and day: ``keys…, day, v``."""
    return series.select(*keys, F.posexplode("values").alias("day", "v"))


def quality_filter(series: DataFrame, kept: Sequence[str] | None = None, max_missing: int = 50) -> DataFrame:
    """Rows of the kept measurements with at most ``max_missing`` missing values."""
    rows = series.where(vec.missing(F.col("values")) <= max_missing)
    return rows.where(F.col("measurement").isin(*kept)) if kept else rows


def value_stats(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, deviation and the outer 0.1 % and 1 % quantiles of all values of a group."""
    values = explode_days(series, by).where(F.col("v").isNotNull())
    moments = values.groupBy(*by).agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")
    )
    names = {0.001: "low1000", 0.01: "low100", 0.99: "high100", 0.999: "high1000"}
    tails = exact_quantiles(values, "v", list(names), by).groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()]
    )
    return join_groups(moments, tails, list(by), "left")


def value_sample(series: DataFrame, by: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """A sample of the present values of every group, in order."""
    values = explode_days(series, by).where(F.col("v").isNotNull())
    return values.sample(fraction=fraction, seed=seed).select(*by, "v").orderBy(*by, "v")


def value_draw(series: DataFrame, by: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` of the present values of every group, drawn without regard to the layout: ``by…, key…, day, v, draw``."""
    values = explode_days(series, [*by, *key]).where(F.col("v").isNotNull())
    return bounded_sample(values, by, [*key, "day"], k, seed)


def missing_draw(series: DataFrame, by: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """Missing values per row, for ``k`` rows of every group: ``by…, key…, missing, draw``."""
    rows = series.select(*by, *key, vec.missing(F.col("values")).alias("missing"))
    return bounded_sample(rows, by, key, k, seed)


def day_stats(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per day: sum, number of values present, and their mean."""
    return explode_days(series, by).groupBy(*by, "day").agg(
        F.sum("v").alias("e"), F.count("v").alias("ne"), F.avg("v").alias("mean")
    )


def _held_rows(held: dict[tuple, list[np.ndarray]], by: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Matrices as rows that hold the part from the diagonal on."""
    for name, matrices in held.items():
        d = len(matrices[0])
        keys = [pa.array([part] * d, type=schema.field(c).type) for c, part in zip(by, name)]
        upper = np.triu_indices(d)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.arange(d, 0, -1))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(m[upper])) for m in matrices]
        columns = [*keys, pa.array(np.arange(d, dtype=np.int32)), *lists]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def _matrix_sums(
    rows: DataFrame, by: list[str], names: Sequence[str], products: Callable[[np.ndarray], list[np.ndarray]]
) -> DataFrame:
    """Sums of d×d matrices that ``products`` makes of the vectors of a group, NaN for missing, as cells: ``by…, i, j, names…`` for i ≤ j.

    Tasks add up dense matrices, at most ``HELD_BYTES`` of them at once, and hand on d²/2
    sums per group; these are added row by row in two rounds, first within salted
    parts of a group's row, and only the totals become one row per cell.
    """
    schema = T.StructType(
        [rows.schema[c] for c in by]
        + [T.StructField("i", T.IntegerType())]
        + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in names]
    )
    arrow = to_arrow_schema(schema)

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            values = matrix_of(batch.column("values"))
            for name, members in groups_of([batch.column(c) for c in by], batch.num_rows):
                sums = products(values[members])
                if name in held:
                    for total, part in zip(held[name], sums):
                        total += part
                else:
                    held[name] = sums
                if len(held) * 8 * len(names) * len(sums[0]) ** 2 > HELD_BYTES:
                    yield from _held_rows(held, by, arrow)
                    held = {}
        yield from _held_rows(held, by, arrow)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in [*by, "i"]))
            for key, *lists in zip(keys, *(batch.column(name) for name in names)):
                parts = [one.values.to_numpy() for one in lists]
                if key in totals:
                    for total, part in zip(totals[key], parts):
                        total += part
                else:
                    totals[key] = [part.copy() for part in parts]
        for key, sums in totals.items():
            keys = [pa.array([part], type=arrow.field(c).type) for c, part in zip([*by, "i"], key)]
            yield pa.RecordBatch.from_arrays([*keys, *(list_column(one[None, :]) for one in sums)], names=arrow.names)

    partial = rows.mapInArrow(multiply, schema)
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part")
    merged = partial.select("*", part).repartition(*by, "i", "part").drop("part").mapInArrow(add_up, schema)
    whole = merged.repartition(*by, "i").mapInArrow(add_up, schema)
    cells = whole.select(*by, "i", F.posexplode_outer(F.arrays_zip(*names)).alias("at", "s"))
    return cells.select(*by, "i", (F.col("i") + F.col("at")).alias("j"), *(F.col(f"s.{name}").alias(name) for name in names))


def augmented_moments(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums of products of the vectors (1, x), in one pass over the series.

    Position 0 is the constant, position i + 1 is day i.  For i ≤ j, ``o`` is the
    sum of products and ``no`` the number of series with both positions present;
    row 0 therefore holds the sums and counts that the means need.
    """

    def products(values: np.ndarray) -> list[np.ndarray]:
        matrix = np.hstack([np.ones((len(values), 1)), values])
        mask = (~np.isnan(matrix)).astype(np.float64)
        matrix = np.nan_to_num(matrix, copy=False)
        return [matrix.T @ matrix, mask.T @ mask]

    rows = series.where(F.col("values").isNotNull()).select(*by, "values")
    return _matrix_sums(rows, list(by), ["o", "no"], products).withColumn("no", F.col("no").cast("long"))


def centred_moments(series: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Co-moments of deviations from a shift per day, and the days: ``by…, day, shift, rest``.

    The shift is the mean of a day, ``rest`` what is left of it after rounding.  For i ≤ j, over the series that have both days,
    ``o`` is the sum of products, ``no`` the number of series, ``s`` the sum of deviations of day i and ``t`` that of day j.
    """
    by = list(by)

    def products(values: np.ndarray) -> list[np.ndarray]:
        mask = (~np.isnan(values)).astype(np.float64)
        known = np.nan_to_num(values)
        sums = known.T @ mask
        return [known.T @ known, mask.T @ mask, sums, np.ascontiguousarray(sums.T)]

    rows = series.where(F.col("values").isNotNull()).select(*by, "values")
    means = day_stats(rows, by).select(*by, "day", F.coalesce("mean", F.lit(0.0)).alias("shift"))
    in_order = F.array_sort(F.collect_list(F.struct("day", "shift")))
    shifts = stage(means.groupBy(*by).agg(F.transform(in_order, lambda d: d["shift"]).alias("shifts")), "shifts")
    moved = F.zip_with("values", "shifts", lambda v, s: v - s)
    shifted = join_groups(rows, shifts, by) if by else rows.withColumn("shifts", shifts.scalar())
    cells = stage(_matrix_sums(shifted.select(*by, moved.alias("values")), by, ["o", "no", "s", "t"], products), "co-moments")
    rest = cells.where("i = j").select(*by, F.col("i").alias("day"), F.try_divide("s", "no").alias("rest"))
    days = shifts.select(*by, F.posexplode("shifts").alias("day", "shift"))
    return cells, stage(join_groups(days, rest, [*by, "day"]), "days")


def second_moments(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per pair of days i ≤ j: sum of products and number of series that have both."""
    cells = augmented_moments(series, by).where(F.col("i") > 0)
    return cells.withColumns({"i": F.col("i") - 1, "j": F.col("j") - 1})


def covariance(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Covariance of days i ≤ j: mean product over the series that have both, minus the product of the means.

    It is put together from deviations of a shift per day, so no two large products are subtracted: with z = x − shift
    and m the mean of z over all series that have the day, E(xᵢxⱼ) − E(xᵢ)E(xⱼ) is E(zᵢzⱼ) − mᵢmⱼ + shiftⱼ (E(zᵢ) − mᵢ) + shiftᵢ (E(zⱼ) − mⱼ), the
    expectations over the series that have both.  Without gaps the last two terms vanish.
    """
    by = list(by)
    cells, days = centred_moments(series, by)
    left = days.withColumnsRenamed({"day": "i", "shift": "shift_i", "rest": "m_i"})
    right = days.withColumnsRenamed({"day": "j", "shift": "shift_j", "rest": "m_j"})
    joined = join_groups(join_groups(cells, left, [*by, "i"]), right, [*by, "j"])
    mean = lambda name: F.try_divide(name, "no")
    tilted = F.col("shift_j") * (mean("s") - F.col("m_i")) + F.col("shift_i") * (mean("t") - F.col("m_j"))
    cov = mean("o") - F.col("m_i") * F.col("m_j") + F.when(F.col("i") == F.col("j"), 0.0).otherwise(tilted)
    return joined.select(*by, "i", "j", cov.alias("cov"))


def variances(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """The diagonal of the covariance, without the other cells."""
    return explode_days(series, by).groupBy(*by, "day").agg(F.var_pop("v").alias("var"))


def mean_std_curves(series: DataFrame, by: Sequence[str], scale: Column | None = None) -> DataFrame:
    """Mean and mean ± deviation per day, divided by ``scale``."""
    scale = F.lit(1.0) if scale is None else scale
    stats = explode_days(series, by).groupBy(*by, "day").agg(
        F.stddev_pop("v").alias("std"), F.avg("v").alias("mean")
    )
    std = F.col("std")
    return stats.select(
        *by,
        "day",
        ((F.col("mean") - std) / scale).alias("mean_minus_std"),
        (F.col("mean") / scale).alias("mean"),
        ((F.col("mean") + std) / scale).alias("mean_plus_std"),
    )


def variance_distance(series: DataFrame, by: str, origin) -> DataFrame:
    """Sum over the days of |Var_origin − Var| for every group of ``by``."""
    var = variances(series, [by])
    base = var.where(F.col(by) == origin).select("day", F.col("var").alias("base"))
    return var.join(base, "day").groupBy(by).agg(F.sum(F.abs(F.col("base") - F.col("var"))).alias("distance"))


def principal_components(series: DataFrame, by: Sequence[str], top: int | None = None) -> DataFrame:
    """Eigenvalues and eigenvectors of each group's covariance, largest first: ``by…, rank, eigval, eigvec``.

    Only the d×d matrix of a group meets in one task.  The sign of a vector is
    fixed by making its component of largest size positive.  A covariance that
    no series determines counts as zero.
    """
    by = list(by)
    cov = covariance(series, by)
    schema = T.StructType(
        [series.schema[c] for c in by]
        + [
            T.StructField("rank", T.IntegerType()),
            T.StructField("eigval", T.DoubleType()),
            T.StructField("eigvec", T.ArrayType(T.DoubleType())),
        ]
    )

    def solve(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
        matrix = np.zeros((j.max() + 1, j.max() + 1))
        matrix[i, j] = matrix[j, i] = np.nan_to_num(cells["cov"].to_numpy(np.float64))
        values, vectors = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")[:top]
        vectors = vectors[:, order]
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
        frame = pd.DataFrame({"rank": np.arange(1, len(order) + 1, dtype=np.int32), "eigval": values[order]})
        frame["eigvec"] = list((vectors * signs).T)
        for column, part in zip(by, key):
            frame[column] = part
        return frame[[*by, "rank", "eigval", "eigvec"]]

    return cov.groupBy(*by).applyInPandas(solve, schema)


def eigenvector_table(components: DataFrame, by: Sequence[str], top: int) -> DataFrame:
    """The first ``top`` eigenvectors in long form: ``by…, rank, day, value``."""
    return components.where(F.col("rank") <= top).select(*by, "rank", F.posexplode("eigvec").alias("day", "value"))
