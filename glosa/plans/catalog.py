"""All registered queries; importing the modules fills the registry."""

from glosa.plans import content_queries, corpus_queries, io_queries, model_queries, text_queries  # noqa: F401
from glosa.plans.registry import QUERIES, oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
