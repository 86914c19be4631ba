"""Registered queries: every operator over the given tables, each next to its independent SQL."""

from importlib import import_module

MODULES = ["recon", "expressions", "scalars", "formats", "files", "landing"]


def load():
    """All registered queries and their oracles."""
    from catalog import registry

    for name in MODULES:
        import_module(f"catalog.{name}")
    return registry.QUERIES, registry.ORACLES
