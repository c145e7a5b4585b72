"""All registered queries and their SQL oracles."""

from __future__ import annotations

from voltaflow.plans import control_queries, solar_queries


def queries():
    out = {}
    out.update(control_queries.QUERIES)
    out.update(solar_queries.QUERIES)
    return out


def oracle_sql():
    out = {}
    out.update(control_queries.ORACLE)
    out.update(solar_queries.ORACLE)
    return out
