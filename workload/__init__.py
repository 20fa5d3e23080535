"""The driver's queries: every operator run over the given tables, with its SQL counterpart."""

from importlib import import_module

_MODULES = ("scalars", "relations", "merges", "repairs", "imports", "stores")


def all_queries():
    """(name -> Spark query, name -> SQL)."""
    from workload.registry import ORACLES, QUERIES

    for module in _MODULES:
        import_module(f"workload.{module}")
    return QUERIES, ORACLES
