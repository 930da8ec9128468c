"""Registry of named queries (``queries()``) and their DuckDB oracles (``oracle_sql()``)."""

from __future__ import annotations

import importlib

_QUERY_MODULES = ["feature_queries", "scoring_queries", "prediction_queries", "selection_queries", "prep_queries", "csv_queries", "model_queries"]
_ORACLE_MODULES = ["oracle_features", "scoring_queries", "prediction_queries", "selection_queries", "prep_queries", "csv_queries", "model_queries"]


def queries() -> dict:
    out: dict = {}
    for m in _QUERY_MODULES:
        out.update(importlib.import_module(f"{__package__}.{m}").QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ORACLE_MODULES:
        out.update(importlib.import_module(f"{__package__}.{m}").oracles())
    return out
