"""All registered queries."""

from promptmill.plans import (queries_evaluate, queries_prompts, queries_rows, queries_sources,  # noqa: F401
                              queries_threads, queries_tokens)
from promptmill.plans.kit import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
