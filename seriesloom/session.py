"""Session defaults used by the benchmark and the tests.

Results never depend on these.  How evenly crowded keys are split does: other sessions should set the
adaptive options below as well.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from seriesloom.shipping import ship_package


def build_session(app: str = "seriesloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # also where the split costs a later shuffle
        "spark.sql.requireAllClusterKeysForDistribution": "true",  # never group by few keys on a placement by fewer
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session
