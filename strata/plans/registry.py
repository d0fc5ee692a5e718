"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from strata.plans import answer_queries, document_queries, table_queries

QUERIES = {**table_queries.QUERIES, **document_queries.QUERIES, **answer_queries.QUERIES}
ORACLE = {**table_queries.ORACLE, **document_queries.ORACLE, **answer_queries.ORACLE}
