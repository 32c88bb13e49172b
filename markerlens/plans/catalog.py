"""All registered queries. Importing the query modules fills the registry."""

from __future__ import annotations

from markerlens.plans import (  # noqa: F401  (imported for their @register side effects)
    agreement_queries,
    corpus_queries,
    evaluate_queries,
    feature_queries,
    marker_queries,
    model_queries,
    report_queries,
    search_queries,
)
from markerlens.plans.registry import OPERATORS, ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)


def operators():
    return dict(OPERATORS)
