"""All registered queries of this package."""

import corpus_pipeline
from lakestrata.llm import queries_native, queries_text  # noqa: F401
from lakestrata.llm.registry import CHECKS, check

check("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["CHECKS"]
