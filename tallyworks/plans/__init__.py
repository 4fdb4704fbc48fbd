"""Registered queries: every operator on the star-schema tables, with the SQL that must agree."""

from tallyworks.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "oracle_sql", "queries"]
