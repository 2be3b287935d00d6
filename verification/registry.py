"""Everything registered, in one place."""

from __future__ import annotations

from verification import entry_queries, forecast_oracle, forecast_queries, lasso_oracle, oracle, run_queries
from verification import queries as core


def queries():
    return core.shown({**core.QUERIES, **forecast_queries.QUERIES, **entry_queries.QUERIES, **run_queries.QUERIES})


def oracle_sql():
    return {**oracle.oracle_sql(), **forecast_oracle.oracle_sql(), **lasso_oracle.oracle_sql(), **entry_queries.ORACLE, **run_queries.oracle_sql()}
