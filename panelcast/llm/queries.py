"""All queries of this subpackage."""

from panelcast.llm import model_queries, record_queries, text_queries  # noqa: F401
from panelcast.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
