"""Fills the registry of this subpackage."""

from memberlytics.llm import decontaminate, language, licenses, merkle, multi_index, packing, pii, preferences, ranked_search, secrets, simhash, token_counts, warc  # noqa: F401
from memberlytics.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
