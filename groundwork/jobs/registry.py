"""All registered queries of the library (other than those of the llm subpackage) and their comparison SQL."""

from __future__ import annotations

from groundwork.jobs import round_queries, row_queries, score_queries, source_queries
from groundwork.jobs.bindings import Tables

_ALL = {**source_queries.QUERIES, **row_queries.QUERIES, **score_queries.QUERIES, **round_queries.QUERIES}


def _query(make):
    return lambda spark, sf_dir: make(Tables(spark, sf_dir))


QUERIES = {name: _query(make) for name, (make, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
