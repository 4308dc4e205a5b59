"""Registered queries and their SQL twins."""

from importlib import import_module

MODULES = ["orders", "archives", "reconcile", "catalog", "listing", "loads", "links", "events"]


def load_queries():
    """All queries and all SQL twins by name."""
    for name in MODULES:
        import_module(f"cartloom.plans.{name}")
    from cartloom.plans.registry import QUERIES, SQL

    return QUERIES, SQL
