"""Registered queries over the test tables, each next to SQL that says the same."""

from importlib import import_module

GROUPS = ("records", "scores", "scalars")


def load():
    """The registry module, filled."""
    for group in GROUPS:
        import_module(f"limpid.catalog.{group}")
    return import_module("limpid.catalog.registry")
