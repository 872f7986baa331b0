"""Profiles of columns: moments, tables, histograms, frequent items, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COLUMNS = 1000


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column."""
    measures = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    flat = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return flat.select(F.inline(F.array(*rows)))


def finite(value: Column) -> Column:
    """The value as a double; NULL for NaN and infinities, which have no place in a range."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def min_max_scaled(df: DataFrame, value: str, name: str = "scaled") -> DataFrame:
    """Add the value's position between the column's finite minimum (0) and maximum (1).

    NULL without a range, and for values that are not finite.
    """
    number = finite(F.col(value))
    low, high = df.agg(F.min(number)).scalar(), df.agg(F.max(number)).scalar()
    return df.withColumn(name, F.try_divide(number - low, high - low))


def bounding_box(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """Extremes of two coordinates, the centre, and a margin of a quarter of each side."""
    box = df.agg(
        F.min(latitude).alias("min_lat"),
        F.max(latitude).alias("max_lat"),
        F.min(longitude).alias("min_long"),
        F.max(longitude).alias("max_long"),
    )
    return box.select(
        "*",
        ((F.col("min_lat") + F.col("max_lat")) / 2).alias("centre_lat"),
        ((F.col("min_long") + F.col("max_long")) / 2).alias("centre_long"),
        ((F.col("max_lat") - F.col("min_lat")) / 4).alias("margin_lat"),
        ((F.col("max_long") - F.col("min_long")) / 4).alias("margin_long"),
    )


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number 0 … bins−1 of equal widths; the last bin holds its upper end."""
    at = F.floor(F.try_divide((value - low) * bins, high - low))
    return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Rows in equal bins between the finite minimum and maximum: ``bin, low, high, n``, empty bins included.

    NULL, NaN and infinite values are not counted.
    """
    known = df.select(finite(F.col(value)).alias("v")).where("v IS NOT NULL")
    ends = known.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")))
    counts = (
        known.withColumn("ends", ends.scalar())
        .groupBy(_bin(F.col("v"), F.col("ends.low"), F.col("ends.high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = frame.join(counts, "bin", "left").withColumn("ends", ends.scalar())
    width = (F.col("ends.high") - F.col("ends.low")) / bins
    return filled.select(
        "bin",
        (F.col("ends.low") + F.col("bin") * width).alias("low"),
        (F.col("ends.low") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def tail_histogram(df: DataFrame, value: str, threshold: float, body_bins: int = 20, tail_bins: int = 40) -> DataFrame:
    """Two histograms, below and from ``threshold``, next to the share of zeros, mean and deviation.

    Only occupied bins are listed.  NULL, NaN and infinite values are not counted.
    """
    known = df.select(finite(F.col(value)).alias("v")).where("v IS NOT NULL")
    in_tail = F.col("v") >= threshold
    facts = known.agg(
        F.struct(
            F.min("v").alias("body_low"),
            F.max(F.when(~in_tail, F.col("v"))).alias("body_high"),
            F.min(F.when(in_tail, F.col("v"))).alias("tail_low"),
            F.max("v").alias("tail_high"),
            F.avg((F.col("v") == 0).cast("double")).alias("zero_share"),
            F.avg("v").alias("mean"),
            F.stddev_pop("v").alias("stddev"),
        )
    ).scalar()
    body = _bin(F.col("v"), F.col("f.body_low"), F.col("f.body_high"), body_bins)
    tail = _bin(F.col("v"), F.col("f.tail_low"), F.col("f.tail_high"), tail_bins)
    counts = (
        known.withColumn("f", facts)
        .groupBy(in_tail.alias("in_tail"), F.when(in_tail, tail).otherwise(body).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.withColumn("f", facts).select("in_tail", "bin", "n", "f.zero_share", "f.mean", "f.stddev")


def distinct_labels(df: DataFrame, column: str, limit: int = MAX_COLUMNS) -> list:
    """The sorted distinct values of a column that is to become columns; more than ``limit`` is an error."""
    found = [row[0] for row in df.select(column).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values: stay with the long form")
    return sorted(found, key=lambda v: (v is not None, v))


def pair_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Rows of every pair of values that occurs, ``rows, columns, n``: a table of any number of labels."""
    return df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))


def pair_means(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Mean value of every pair that occurs, ``rows, columns, cell``."""
    return df.groupBy(rows, columns).agg(F.avg(value).alias("cell"))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """``pair_counts`` as a wide table for output, absent pairs as zero; a NULL label is the column ``null``."""
    wide = pair_counts(df, rows, columns).groupBy(rows).pivot(columns, distinct_labels(df, columns)).agg(F.sum("n"))
    return wide.na.fill(0, subset=[c for c in wide.columns if c != rows])


def pivot_mean(df: DataFrame, rows: str, columns: str, value: str, prefix: str) -> DataFrame:
    """``pair_means`` in wide form for output, one column per distinct value of ``columns``, NULL as ``null``.

    Pairs are aggregated in long form first, so each cell of the pivot is unique.
    """
    labels = distinct_labels(df, columns)
    wide = pair_means(df, rows, columns, value).groupBy(rows).pivot(columns, labels).agg(F.first("cell"))
    return wide.toDF(rows, *[f"{prefix}{'null' if v is None else v}" for v in labels])


def frequent_items(df: DataFrame, column: str, support: float) -> DataFrame:
    """Values, NULL among them, that make up more than ``support`` of the rows, with their exact counts.

    Spark's sketch names the candidates (at most 1 / support of them, possibly
    too many); one recount of these removes the false ones.
    """
    candidates = df.stat.freqItems([column], support).select(F.explode(f"{column}_freqItems").alias("item"))
    values = df.select(F.col(column).alias("value"))
    counts = values.join(candidates, F.col("value").eqNullSafe(F.col("item"))).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return counts.where(F.col("n") > support * rows)


def approx_quantiles(df: DataFrame, column: str, probs: Sequence[float], error: float) -> DataFrame:
    """Quantiles of rank error at most ``error``: ``prob, quantile``."""
    accuracy = max(1, round(1 / error))
    at = F.percentile_approx(column, [float(p) for p in probs], accuracy)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("q").alias("quantile"))
    return df.agg(at.alias("q")).select(F.inline(pairs).alias("prob", "quantile"))


def signal_to_noise(df: DataFrame, value: str, by: str) -> DataFrame:
    """Largest and smallest mean / deviation over the groups; groups without spread do not count."""
    ratio = F.try_divide(F.avg(value), F.stddev_samp(value))
    return df.groupBy(by).agg(ratio.alias("ratio")).agg(
        F.max("ratio").alias("max_ratio"), F.min("ratio").alias("min_ratio")
    )


def scaled_units(value: Column, measurement: Column, tenths: Sequence[str]) -> Column:
    """Measurements stored in tenths of a unit, as whole units."""
    return F.when(measurement.isin(*tenths), value / 10).otherwise(value)
