import subprocess
import sys
import textwrap

from seriesloom import staging


def test_staged_tables_lie_in_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert staging.scratch_path(spark).startswith(staging.shared_dir(spark))
    if folder:
        assert staging.shared_dir(spark) == folder.rstrip("/")


def test_a_staged_table_is_read_back_with_its_types(spark):
    df = spark.range(5).selectExpr("id", "array(cast(id AS double)) AS v")
    back = staging.stage(df)
    assert back.schema.simpleString() == df.schema.simpleString() and back.count() == 5


def test_the_folder_goes_with_the_session(tmp_path):
    script = f"""
        import sys
        sys.path.insert(0, {sys.path[0]!r})
        from seriesloom.session import build_session
        from seriesloom.staging import stage
        spark = build_session("t", "local[1]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.ui.enabled": "false"}})
        assert stage(spark.range(3)).count() == 3
        spark.stop()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(script)], check=True, capture_output=True, timeout=120)
    assert not list(tmp_path.glob("seriesloom-*"))


def test_tables_go_with_their_block(spark):
    import os

    from seriesloom.staging import passing, stage

    path = lambda df: df.inputFiles()[0].removeprefix("file://")
    with passing() as outer:
        with passing() as keep:
            gone, kept = stage(spark.range(3)), keep(stage(spark.range(4)))
            files = path(gone), path(kept)
        assert not os.path.exists(files[0]) and kept.count() == 4
        last = outer(stage(spark.range(5)))
    assert not os.path.exists(files[1]) and last.count() == 5


def test_kernels_run_without_the_package_on_the_path(tmp_path):
    """A driver started elsewhere, whose workers see neither the repository nor PYTHONPATH."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from seriesloom.session import build_session\n"
        "spark = build_session('away', 'local[2]', **{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2'})\n"
        "from seriesloom.operators.series_stats import second_moments\n"
        "df = spark.createDataFrame([('a', [1.0, 2.0])], 'g string, values array<double>')\n"
        "print('cells', second_moments(df, ['g']).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "cells 3" in done.stdout, done.stderr[-2000:]
