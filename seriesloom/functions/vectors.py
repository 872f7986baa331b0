"""Column expressions over ``array<double>`` vectors; a NULL element is a missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(values: Column) -> Column:
    """Number of non-missing elements."""
    return F.size(F.filter(values, lambda v: v.isNotNull()))


def missing(values: Column) -> Column:
    """Number of missing elements."""
    return F.size(F.filter(values, lambda v: v.isNull()))


def total(values: Column) -> Column:
    """Sum of the elements, missing ones counting as zero."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))


def dot(left: Column, right: Column) -> Column:
    """Inner product, a missing element on either side counting as zero."""
    return total(F.zip_with(left, right, lambda a, b: a * b))


def square_norm(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v * v, F.lit(0.0)))


def minus(left: Column, right: Column) -> Column:
    """Element-wise difference; missing where either side is missing."""
    return F.zip_with(left, right, lambda a, b: a - b)


def add_scaled(left: Column, factor: Column, right: Column) -> Column:
    """``left + factor * right`` element by element."""
    return F.zip_with(left, right, lambda a, b: a + factor * b)


def nan_to_null(values: Column) -> Column:
    return F.transform(values, lambda v: F.when(F.isnan(v), F.lit(None)).otherwise(v))
