"""Named queries over the test tables.  Importing the package fills the registry."""

from memberlytics.plans.catalog import ORACLES, QUERIES
from memberlytics.plans import panel_queries, window_queries, join_queries, feature_queries, label_queries, source_queries, model_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
