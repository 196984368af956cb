"""All registered queries."""

from textloom.plans import (  # noqa: F401
    corpus_queries,
    exact_queries,
    label_queries,
    model_queries,
    source_queries,
    text_queries,
)
from textloom.plans.catalog import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
