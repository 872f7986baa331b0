"""Relational queries on rows of the tests' own."""

import pytest

from seriesloom.plans import QUERIES


@pytest.mark.parametrize("keys, kind", [([1, 2, None, 3], "bigint"), ([3_000_000_000, 3_000_000_000], "decimal(38,0)"), ([], "bigint")])
def test_sums_of_squares_beyond_64_bits(spark, tmp_path, keys, kind):
    spark.createDataFrame([(k,) for k in keys], "l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["sum_squares"](spark, str(tmp_path))
    assert found.dtypes == [("total", kind)]
    assert found.first()["total"] == (sum(k * k for k in keys if k) if keys else None)
