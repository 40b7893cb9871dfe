"""Queries over the test tables, each with the SQL that has to give the same rows."""

from . import (  # noqa: F401
    choice_queries, corpus_queries, io_queries, join_queries, order_queries, rule_queries,
    text_queries, token_queries, vector_queries,
)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
