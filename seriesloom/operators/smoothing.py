"""Gaussian smoothing of long signals across gaps.

A signal is cut into blocks of consecutive samples.  Every block also sends the
samples within half a window of its ends to its neighbours, so that each block
can be smoothed alone; a signal of any length is spread over many tasks, and
the shuffle grows by the width of the window only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.ordered import join_groups, place_rows
from seriesloom.staging import stage

# The window.
ORDER = 101
STD = 20.0
BLOCK = 512
SPAN = 4096
STACKED_CELLS = 1 << 20  # samples that are transformed at once
DIRECT_CELLS = 1 << 20
LEAST_MASS = 1e-7
EDGES = ("renormalise", "zero")


def gaussian_window(order: int = ORDER, std: float = STD) -> np.ndarray:
    offsets = np.arange(order) - (order - 1) / 2
    weights = np.exp(-0.5 * (offsets / std) ** 2)
    return weights / weights.sum()


def _fast_length(n: int) -> int:
    """The next length without prime factors above 5, for which a transform is quick."""
    while True:
        rest = n
        for factor in (2, 3, 5):
            while rest % factor == 0:
                rest //= factor
        if rest == 1:
            return n
        n += 1


def smoothed_rows(padded: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted means of the samples present around every inner position of blocks, given as rows of one length; NaN where there are none.

    Overlap-save: each block holds the samples that its ends reach, so one product of transforms per block gives all of its
    inner positions.  Where the present samples have little weight, as at the far end of the window in a gap,
    rounding of the transform would count; these positions are summed directly.
    """
    order, width = len(weights), padded.shape[1]
    inner = width - order + 1
    there = ~np.isnan(padded)
    known = there.sum(axis=1)
    middle = np.divide(np.where(there, padded, 0.0).sum(axis=1), known, out=np.zeros(len(padded)), where=known > 0)
    values = np.where(there, padded - middle[:, None], 0.0)
    size = _fast_length(width)
    window = np.fft.rfft(weights, size)
    sums, mass = (np.fft.irfft(np.fft.rfft(rows, size) * window, size)[:, order - 1 : width] for rows in (values, there.astype(np.float64)))
    upto = np.concatenate([np.zeros((len(padded), 1), np.int64), np.cumsum(there, axis=1)], axis=1)
    reached = upto[:, order:] > upto[:, :inner]
    out = np.divide(sums, mass, out=np.full_like(sums, np.nan), where=reached & (mass > LEAST_MASS)) + middle[:, None]
    row, at = np.nonzero(reached & (mass <= LEAST_MASS))
    for start in range(0, len(row), DIRECT_CELLS // order + 1):
        r, a = row[start : start + DIRECT_CELLS // order + 1], at[start : start + DIRECT_CELLS // order + 1]
        around = a[:, None] + np.arange(order)
        # Weights relative to the nearest sample present, so that none of them vanishes.
        present = there[r[:, None], around]
        scaled = np.where(present, np.log(weights, where=weights > 0, out=np.full(order, -np.inf))[::-1], -np.inf)
        scaled = np.exp(scaled - np.maximum(scaled.max(axis=1, keepdims=True), -1e300))
        total = scaled.sum(axis=1)
        out[r, a] = np.where(total > 0, (scaled * values[r[:, None], around]).sum(axis=1) / np.where(total > 0, total, 1), np.nan) + middle[r]
    return out


def _convolve(padded: Column, order: int, std: float) -> Column:
    """Weighted mean of the samples present around every inner position of a padded block."""

    @F.arrow_udf("array<double>")
    def smooth(column: pa.Array) -> pa.Array:
        weights = gaussian_window(order, std)
        lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.maximum(lengths - order + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(offsets[-1])
        for length in np.unique(lengths[sizes > 0]):  # all but the last blocks of signals have one length
            members = np.flatnonzero(lengths == length)
            for part in np.array_split(members, -(-len(members) * int(length) // STACKED_CELLS)):
                rows = smoothed_rows(flat[starts[part][:, None] + np.arange(length)], weights)
                out[offsets[part][:, None] + np.arange(rows.shape[1])] = rows
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out, mask=np.isnan(out)))

    return smooth(padded)


def smooth_blocks(
    blocks: DataFrame,
    by: Sequence[str],
    block: str,
    length: int,
    order: int = ORDER,
    std: float = STD,
    edges: str = "renormalise",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Smooth ``values`` of consecutive blocks of ``length`` samples; the last block of a signal may be shorter.

    Missing samples take no part and the weights of the others are scaled up, so
    gaps are filled.  Beyond the ends of a signal there is nothing
    (``renormalise``) or zero (``zero``).  A NULL block is ``length`` missing samples.  ``carry`` names further columns to keep.
    """
    if edges not in EDGES:
        raise ValueError(f"edges must be one of {EDGES}")
    if order % 2 == 0:
        raise ValueError("the window needs an odd number of samples")
    half = order // 2
    reach = -(-half // length)
    by = list(by)
    outside = F.lit(0.0) if edges == "zero" else F.lit(None).cast("double")

    def width(distance: int) -> int:
        return min(length, half - (abs(distance) - 1) * length)

    blocks = blocks.withColumn("values", F.coalesce("values", F.array_repeat(F.lit(None).cast("double"), length)))
    own = F.struct(*carry) if carry else F.lit(None).cast("int")
    nothing = F.when(F.lit(False), own)

    def share(distance: int, part: Column, row: Column) -> Column:
        return F.struct(F.lit(distance).alias("from"), part.alias("part"), row.alias("row"))

    shares = [share(0, F.col("values"), own)]
    for distance in range(1, reach + 1):
        n = width(distance)
        head, tail = F.slice("values", 1, n), F.slice("values", length - n + 1, n)
        shares.append(share(distance, head, nothing))
        shares.append(share(-distance, tail, nothing))
    sent = blocks.select(*by, block, F.explode(F.array(*shares)).alias("s")).select(
        *by, (F.col(block) - F.col("s.from")).alias(block), "s.from", "s.part", "s.row"
    )
    # Given, because the blocks of a signal would otherwise stay together after an aggregation per signal.
    sent = sent.repartition(*by, block)
    parts = {
        distance: F.first(F.when(F.col("from") == distance, F.col("part")), ignorenulls=True).alias(f"part_{distance + reach}")
        for distance in range(-reach, reach + 1)
    }
    row = F.first("row", ignorenulls=True).alias("row")
    met = sent.groupBy(*by, block).agg(*parts.values(), row).where(F.col(f"part_{reach}").isNotNull())

    def filled(distance: int) -> Column:
        part, n = F.col(f"part_{distance + reach}"), width(distance)
        known = F.coalesce(part, F.array().cast("array<double>"))
        return F.concat(known, F.array_repeat(outside, F.lit(n) - F.size(known)))

    padded = F.concat(
        *[filled(d) for d in range(-reach, 0)], F.col(f"part_{reach}"), *[filled(d) for d in range(1, reach + 1)]
    )
    kept = [F.col(f"row.{c}").alias(c) for c in carry]
    return met.select(*by, block, *kept, _convolve(padded, order, std).alias("values"))


def smooth_signal(
    samples: DataFrame,
    by: Sequence[str],
    position: str,
    value: str,
    order: int = ORDER,
    std: float = STD,
    edges: str = "renormalise",
    length: int | None = None,
) -> DataFrame:
    """Smooth samples at integer positions, one row each: ``by…, position, smooth``.

    Positions without a row are missing.  A signal starts at 0, or before it at its first position, and ends at its last
    one; rows without a position are left out.  Blocks have ``length`` samples, by default as many as the window at least, so
    that a block is shared with its two neighbours only.
    """
    by, length = list(by), length or max(BLOCK, order)
    start = F.least(F.min(position), F.lit(0)).cast("long")
    ends = stage(samples.where(F.col(position).isNotNull()).groupBy(*by).agg(start.alias("start_"), F.max(position).alias("last_")), "signals")
    samples = join_groups(samples, ends.drop("last_"), by).withColumn(position, F.col(position) - F.col("start_"))
    last = ends.select(*by, "start_", (F.col("last_") - F.col("start_")).alias("last_"))
    final = F.floor(F.col("last_") / length)  # numbered in two levels, so that no array is long
    spans = last.select(*by, "start_", "last_", F.explode(F.sequence(F.lit(0).cast("long"), final, F.lit(SPAN))).alias("span_"))
    numbers = F.sequence(F.col("span_"), F.least(F.col("span_") + SPAN - 1, final))
    frame = spans.select(*by, "start_", "last_", F.explode(numbers).alias("block_"))
    cells = samples.where(F.col(value).isNotNull()).select(
        *by,
        F.floor(F.col(position) / length).alias("block_"),
        F.struct((F.col(position) % length).cast("int").alias("at"), F.col(value).cast("double").alias("v")).alias("cell"),
    )
    packed = cells.groupBy(*by, "block_").agg(F.map_from_entries(F.collect_list("cell")).alias("cells"))
    size = F.least(F.lit(length), F.col("last_") + 1 - F.col("block_") * length).cast("int")
    blocks = join_groups(frame, packed, [*by, "block_"], "left").select(
        *by,
        "block_",
        "start_",
        F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.try_element_at("cells", i)).alias("values"),
    )
    smoothed = smooth_blocks(blocks, by, "block_", length, order, std, edges, ["start_"])
    rows = smoothed.select(*by, "block_", "start_", F.posexplode_outer("values").alias("at_", "smooth"))
    return rows.select(*by, (F.col("start_") + F.col("block_") * length + F.col("at_")).alias(position), "smooth")


def smooth_series(
    series: DataFrame,
    days: int = 365,
    order: int = ORDER,
    std: float = STD,
    edges: str = "renormalise",
) -> DataFrame:
    """Smooth every station's series along its rows in year order.

    Rows that follow each other count as adjacent even if years are absent
    between them.  The result has the measurement ``smooth_<measurement>``.
    """
    by = ["station", "measurement"]
    placed = place_rows(series, ["year"], by).withColumnRenamed("before", "row_")
    others = [c for c in series.columns if c not in (*by, "values")]
    rows = smooth_blocks(placed, by, "row_", days, order, std, edges, others)
    return rows.withColumn("measurement", F.concat(F.lit("smooth_"), "measurement")).select(*series.columns)


def append_smoothed(series: DataFrame, days: int = 365, **window) -> DataFrame:
    """The series and their smoothed versions in one table."""
    return series.unionByName(smooth_series(series, days, **window))
