"""Every query with an oracle gives the same rows as its SQL; the others give rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from seriesloom.plans import ORACLES, QUERIES



@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, tables, duck, name):
    assert compare(spark, tables, duck, QUERIES[name], ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["group_id", "token", "popularity", "rank"]


@pytest.mark.parametrize("name", ["ccdf", "exact_quantiles", "group_by_key", "join_dimension", "lookup_default", "two_way_centering"])
def test_equals_oracle_without_broadcasts(spark, tables, duck, name):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        assert compare(spark, tables, duck, QUERIES[name], ORACLES[name]) == []
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_entry_works_without_the_optional_packages(tmp_path):
    """A missing package of the training-data part leaves the other queries."""
    import subprocess
    import sys
    from pathlib import Path

    for name in ("regex", "tokenizers", "xxhash"):
        (tmp_path / f"{name}.py").write_text(f"raise ModuleNotFoundError('gone', name='{name}')")
    code = "import __spark_entry__ as e; print(sorted(e.queries()))"
    root = str(Path(entry_points.__file__).parent)
    done = subprocess.run([sys.executable, "-c", f"import sys; sys.path[:0] = [{str(tmp_path)!r}, {root!r}]; {code}"], capture_output=True, text=True, check=True)
    assert done.stdout.strip().endswith(str(sorted(QUERIES))) and "left out" in done.stderr
