"""All registered queries."""

from __future__ import annotations

from tintwell.plans import annotation_queries, asset_queries, colour_queries, lineage_queries, source_queries, stream_queries
from tintwell.plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = colour_queries.profile_ranked_topk
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES", "annotation_queries", "asset_queries", "lineage_queries", "source_queries", "stream_queries"]
