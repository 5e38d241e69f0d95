"""Driver contract: FHIR rows derived from the given tables, queries, and their SQL counterparts."""

import importlib

MODULES = ("ingest", "functions", "relational", "models", "changes", "checks")


def load_queries():
    """The registry with every query module imported."""
    for name in MODULES:
        importlib.import_module(f"contract.queries_{name}")
    return importlib.import_module("contract.registry")
