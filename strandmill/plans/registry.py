"""All registered queries of the core and their SQL."""

from __future__ import annotations

from strandmill.plans import cohort_queries, data_quality, evaluation_queries, evidence_queries, length_queries, sequence_queries, tract_queries, unit_queries

_MODULES = (data_quality, length_queries, unit_queries, cohort_queries, sequence_queries, evidence_queries, tract_queries, evaluation_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
