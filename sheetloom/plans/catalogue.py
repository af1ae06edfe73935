"""All registered queries."""

from sheetloom.plans import (  # noqa: F401
    facts_queries, io_queries, match_queries, normalise_queries, output_queries, quality_queries, review_queries,
    run_queries)
from sheetloom.plans.registry import ORACLE, QUERIES  # noqa: F401
