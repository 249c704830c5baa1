"""All registered queries by name, and their SQL."""

from __future__ import annotations

from tracelake.plans import frame_queries, image_queries, model_queries, modulation_queries, ratio_queries, response_queries, shape_queries, signal_queries, skeleton_queries, table_queries, trace_queries, tree_queries, volume_queries

_MODULES = (frame_queries, response_queries, image_queries, modulation_queries, shape_queries, tree_queries, ratio_queries, volume_queries, trace_queries, skeleton_queries)
QUERIES: dict = signal_queries.QUERIES | table_queries.QUERIES | model_queries.QUERIES
ORACLE: dict = signal_queries.ORACLE | table_queries.ORACLE | model_queries.ORACLE
for _module in _MODULES:
    QUERIES |= _module.REGISTRY.queries
    ORACLE |= _module.REGISTRY.sql
