from wicketworks.catalog import layers, modeling, plans, relations, rows, sources  # noqa: F401
from wicketworks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
