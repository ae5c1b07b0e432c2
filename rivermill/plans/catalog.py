"""All registered queries and their SQL."""

from __future__ import annotations

from rivermill.plans import feature_queries, model_queries, prepare_queries, score_queries, source_queries, stream_queries, turbine_queries

MODULES = (source_queries, prepare_queries, feature_queries, score_queries, turbine_queries, stream_queries, model_queries)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
