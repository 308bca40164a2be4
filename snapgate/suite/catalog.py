"""All registered queries by name."""

from __future__ import annotations

from snapgate.suite import cleaning_queries, drift_queries, gate_queries, schema_queries, sources_queries

ALL = {
    **cleaning_queries.QUERIES,
    **sources_queries.QUERIES,
    **schema_queries.QUERIES,
    **drift_queries.QUERIES,
    **gate_queries.QUERIES,
}


def queries():
    return {name: fn for name, (fn, _) in ALL.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in ALL.items() if sql}
