from seriesloom.plans import profile, relational, rows, series, signals, sources, texts  # noqa: F401  (fill the registry)
from seriesloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
