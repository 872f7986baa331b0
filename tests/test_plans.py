"""Shapes of physical plans that matter at scale."""

import re

import pytest

from seriesloom.plans import QUERIES

# Dense kernels or exact integer geometry on Arrow batches.
ARROW = {
    "collinear_sets", "series_second_moments", "gauss_smooth", "gauss_smooth_zero_edges", "smooth_append", "neighbour_diff",
    "pca_eig", "eigvec_long", "variance_explained", "unpack_f16", "fourier_residuals", "decompose_fixed_basis",
    "decompose_pca", "reconstruct", "fit_extremes", "coefficient_extremes", "fit_cdf", "fold_moments", "fold_key_digest",
    "matrix_gram", "matrix_reshape", "matrix_outer",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    if name not in ARROW:
        assert not re.search(r"Python|InPandas|InArrow|ArrowEval", text)
    assert "CartesianProduct" not in text
    if name != "cross_join":
        assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, tables):
    text = plan(QUERIES["src_parquet"](spark, tables))
    assert "GreaterThan(l_discount,0.05)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double>" in text
    assert "EqualTo(l_linestatus,O)" in plan(QUERIES["sql_on_parquet"](spark, tables))
    assert "EqualTo(l_suppkey,42)" in plan(QUERIES["point_lookup"](spark, tables))


def test_top_k_does_not_sort_everything(spark, tables):
    for name in ("top_words", "top_tokens", "take_n", "top_groups", "rarest_groups"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, tables))


def test_aggregates_are_partial_before_the_shuffle(spark, tables):
    for name in ("word_count", "reduce_by_key", "tokenize", "series_day_stats"):
        text = plan(QUERIES[name](spark, tables))
        assert "partial_" in text[text.index("Exchange hashpartitioning") :]


def test_expensive_arrays_are_computed_once(spark, tables):
    for name in ("token_mentions", "tokenize", "rel_popularity", "word_count"):
        text = plan(QUERIES[name](spark, tables))
        assert len(re.findall(r"regexp_extract_all\(|split\(", text)) == 1


def test_blocks_of_a_signal_are_spread_and_smoothed_once(spark, tables):
    text = plan(QUERIES["gauss_smooth"](spark, tables))
    assert text.count("ArrowEvalPython") == 1
    assert re.search(r"Exchange hashpartitioning\(event_type#\d+, block_#\d+L", text)


def test_one_pass_per_direction_of_slices(spark, tables):
    text = plan(QUERIES["rank_slices"](spark, tables))
    assert text.count("FileScan") == 2


def test_series_are_fitted_once(spark, tables):
    """The ranks and filters read a table of the fits, so no plan holds the fit a second time."""
    for name in ("fit_extremes", "coefficient_extremes", "decompose_filter", "fit_cdf"):
        assert plan(QUERIES[name](spark, tables)).count("ArrowEvalPython") <= 1
