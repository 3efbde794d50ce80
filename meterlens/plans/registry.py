"""Registry of driver queries and their DuckDB oracle SQL."""

from __future__ import annotations

from . import meter_oracle, meter_queries, national_oracle, national_queries, ops_oracle, ops_queries


def all_queries() -> dict:
    out = {}
    out.update(meter_queries.QUERIES)
    out.update(national_queries.QUERIES)
    out.update(ops_queries.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    out.update(meter_oracle.ORACLE)
    out.update(national_oracle.ORACLE)
    out.update(ops_oracle.ORACLE)
    return out
