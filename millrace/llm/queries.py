"""The queries of these operators and, where SQL can express one, the SQL it must agree with."""

from millrace.llm import curation, mining, screening
from millrace.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "curation", "mining", "screening"]
