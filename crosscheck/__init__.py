"""Registered queries over the given tables, with a SQL twin for each."""

import importlib

_MODULES = ("q_views", "q_showcase", "q_reports", "q_apps", "q_jobs", "q_ingest", "q_operators")


def load():
    """Import every module that registers queries and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"crosscheck.{name}")
    return importlib.import_module("crosscheck.registry")
