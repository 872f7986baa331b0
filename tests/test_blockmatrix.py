"""Matrices of blocks against numpy."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import blockmatrix as bm
from seriesloom.plans import QUERIES


def matrix(spark, array, block=4):
    rows = [(i, [None if np.isnan(x) else float(x) for x in row]) for i, row in enumerate(array)]
    return bm.from_rows(spark.createDataFrame(rows, "i long, v array<double>").repartition(3), "i", "v", array.shape[1], block)


def dense(m):
    out = np.full((m.rows, m.columns), -9e99)
    for r in m.cells().collect():
        assert out[r["row"], r["column"]] == -9e99  # every element once
        out[r["row"], r["column"]] = r["value"]
    sizes = {(r.row_block, r.col_block): r.n for r in m.blocks.select("row_block", "col_block", F.size("values").alias("n")).collect()}
    assert sizes == {
        (i, j): min(m.block, m.rows - i * m.block) * min(m.block, m.columns - j * m.block)
        for i in range(-(-m.rows // m.block)) for j in range(-(-m.columns // m.block))
    }
    return out


@pytest.fixture(scope="module")
def array():
    return np.random.default_rng(0).normal(size=(10, 7))


@pytest.mark.parametrize("block", [1, 3, 4, 16])
def test_rows_become_blocks_and_turn(spark, array, block):
    m = matrix(spark, array, block)
    assert np.array_equal(dense(m), array) and np.array_equal(dense(m.transpose()), array.T)


@pytest.mark.parametrize("sizes", [(7, 10), (70, 1), (1, 70), (14, 5), (10, 7)])
def test_reshape(spark, array, sizes):
    assert np.array_equal(dense(matrix(spark, array).reshape(*sizes)), array.reshape(sizes))


@pytest.mark.parametrize("sizes", [(8, 9), (24, 3), (1, 71), (71, 1), (12, 10)])
def test_reshape_with_a_rest(spark, array, sizes):
    expected = np.concatenate([array.ravel(), np.full(sizes[0] * sizes[1] - 70, 5.0)]).reshape(sizes)
    assert np.array_equal(dense(matrix(spark, array).reshape(*sizes, rest=5.0)), expected)
    with pytest.raises(ValueError, match="do not fill"):
        matrix(spark, array).reshape(*sizes)


def test_reshape_query_with_a_shorter_last_row(spark, tmp_path):
    """Of 3 series, 2 x 3 x 64 elements, nine rows of 40 are full."""
    vectors = np.random.default_rng(4).normal(size=(3, 64)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {(r["row"], r["column"]): r["value"] for r in QUERIES["matrix_reshape"](spark, str(tmp_path)).collect()}
    filled = np.where(np.abs(vectors.astype(float)) >= 0.01, vectors.astype(float), 0.0).ravel()
    expected = np.round(np.concatenate([filled, 2 * filled]), 6)
    assert len(found) == 384 and all(found[p // 40, p % 40] == pytest.approx(v, abs=2e-6) for p, v in enumerate(expected))


@pytest.mark.parametrize("block", [3, 4])
def test_stacks(spark, array, block):
    other = np.random.default_rng(1).normal(size=(3, 7))
    wide = np.random.default_rng(2).normal(size=(10, 5))
    m = matrix(spark, array, block)
    assert np.array_equal(dense(m.below(matrix(spark, other, block))), np.vstack([array, other]))
    assert np.array_equal(dense(m.beside(matrix(spark, wide, block))), np.hstack([array, wide]))


@pytest.mark.parametrize("block", [1, 3, 4, 16])
def test_products(spark, array, block):
    other = np.random.default_rng(3).normal(size=(7, 9))
    a, b = matrix(spark, array, block), matrix(spark, other, block)
    assert np.allclose(dense(a @ b), array @ other) and np.allclose(dense(a @ a.transpose()), array @ array.T)


@pytest.mark.parametrize("groups", [1, 7])
def test_products_over_one_inner_block_are_not_shuffled(spark, monkeypatch, groups):
    monkeypatch.setattr(bm, "TILE", 2)
    monkeypatch.setattr(bm, "GROUPS_PER_CORE", groups)
    one, two = (np.random.default_rng(seed).normal(size=size) for seed, size in ((5, (43, 4)), (6, (4, 30))))
    product = matrix(spark, one) @ matrix(spark, two)
    assert np.allclose(dense(product), one @ two)
    text = product.blocks._jdf.queryExecution().executedPlan().toString()
    assert text.index("MapInArrow") < text.index("Exchange")  # the topmost exchange lies below the products


def test_products_in_many_parts(spark, array, monkeypatch):
    monkeypatch.setattr(bm, "HELD_BYTES", 200)
    m = matrix(spark, array, 2)
    assert np.allclose(dense(m.transpose() @ m), array.T @ array)


def test_outer_product(spark):
    u, v = np.arange(1.0, 10.0), np.linspace(-1, 1, 6)
    a, b = matrix(spark, u[:, None]), matrix(spark, v[:, None])
    assert np.allclose(dense(bm.outer(a, b)), np.outer(u, v))


def test_missing_elements_spread_as_in_numpy(spark, array):
    holed = array.copy()
    holed[2, 3] = np.nan
    m = matrix(spark, holed)
    assert np.array_equal(np.isnan(dense(m @ m.transpose())), np.isnan(holed @ holed.T))


def test_wrong_sizes_are_refused(spark, array):
    m = matrix(spark, array)
    for wrong in (lambda: m.reshape(3, 3), lambda: m @ m, lambda: m.below(m.transpose()), lambda: bm.outer(m, m)):
        with pytest.raises(ValueError):
            wrong()


def test_blocks_are_joined_by_the_inner_number(spark, array):
    m = matrix(spark, array)
    text = (m @ m.transpose()).blocks._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("block", [4, 16])
def test_cells_are_folded_where_they_are_made(spark, monkeypatch, block):
    """Products over one inner block, and over several, give every element once, and no element leaves its task."""
    monkeypatch.setattr(bm, "TILE", 2)
    monkeypatch.setattr(bm, "HELD_TILES", 1)

    def sums(rows, columns, values):
        return [pa.array(rows), pa.array(values.sum(axis=1)), pa.array(values @ columns.astype(float))]

    array = np.random.default_rng(8).normal(size=(37, 7))
    m = matrix(spark, array, block)
    product, expected = m @ m.transpose(), array @ array.T
    assert np.allclose(dense(product), expected)
    parts = product.cells(sums, "row long, total double, weighted double")
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text[: text.index("MapInArrow")]
    found = parts.groupBy("row").agg(F.sum("total").alias("total"), F.sum("weighted").alias("weighted")).orderBy("row").collect()
    assert [r["row"] for r in found] == list(range(37))
    assert np.allclose([r["total"] for r in found], expected.sum(axis=1))
    assert np.allclose([r["weighted"] for r in found], expected @ np.arange(37.0))


def test_gram_query_hands_over_few_rows(spark, tmp_path):
    """300 series in three blocks: figures of a row come once per part of the other factor, not as 300 cells."""
    vectors = np.random.default_rng(6).normal(size=(300, 64)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    query = QUERIES["matrix_gram"](spark, str(tmp_path))
    assert "posexplode" not in query._jdf.queryExecution().executedPlan().toString()
    found = {r["row"]: r for r in query.collect()}
    a = np.where(np.abs(vectors.astype(float)) >= 0.01, vectors.astype(float), 0.0)
    gram = a @ a.T
    assert len(found) == 300
    for i, r in found.items():
        assert [r["total"], r["largest"], r["own"]] == pytest.approx([gram[i].sum(), gram[i].max(), gram[i, i]], abs=2e-6)
