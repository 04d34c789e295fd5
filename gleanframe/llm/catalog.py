"""All registered queries of this subpackage, the pipeline among them."""

from __future__ import annotations

import corpus_pipeline
from gleanframe.llm import corpus_queries, model_queries, search_queries, text_queries  # noqa: F401  (they register)
from gleanframe.llm.registry import CHECKS, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["CHECKS", "QUERIES"]
