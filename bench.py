"""Times the headline queries and prints one JSON line.

Every query is run once untimed on the smallest tables, so that the figures
show the work on the data and not the start of the JVM and of the Python workers;
then three times on the data, of which the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seriesloom.plans import QUERIES  # noqa: E402
from seriesloom.session import build_session  # noqa: E402

RUNS = 3
HEADLINES = [
    "count_rows",
    "sql_on_parquet",
    "reduce_by_key",
    "group_by_key",
    "join_inner",
    "join_dimension",
    "top_groups",
    "rank_slices",
    "exact_quantiles",
    "ecdf",
    "neighbour_diff",
    "word_count",
    "top_words",
    "tokenize",
    "token_mentions",
    "token_support",
    "posts_per_group",
    "rel_popularity",
    "fold_moments",
    "ingest_series",
    "ingest_table",
    "series_value_stats",
    "series_cov",
    "pca_eig",
    "decompose_pca",
    "fourier_residuals",
    "rms_effects",
    "two_way_centering",
    "gauss_smooth",
    "smooth_append",
    "collinear_sets",
    "matrix_gram",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(folder), "sf0.001")
    for name in HEADLINES:
        run(spark, name, warm if os.path.isdir(warm) else folder)
    times = {name: median(run(spark, name, folder) for _ in range(RUNS)) for name in HEADLINES}
    spark.stop()
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
