"""All registered training-data queries and their SQL."""

from __future__ import annotations

from strandmill.llm import queries

_MODULES = (queries,)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
