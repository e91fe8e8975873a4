"""All registered queries of the interval engine with their DuckDB counterparts."""

from __future__ import annotations

from locusframe.plans import evidence_queries, feature_queries, form_queries, gene_queries, hit_queries, interval_queries, model_queries, output_queries, score_queries, sequence_queries, table_queries  # noqa: F401
from locusframe.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
