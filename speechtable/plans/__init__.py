"""Composed flows over the operators, and the registered queries."""

from importlib import import_module

_MODULES = ("selection_queries", "wave_queries", "degrade_queries", "source_queries", "edge_queries")


def load_queries() -> None:
    """Import the modules that register queries."""
    for name in _MODULES:
        import_module(f"speechtable.plans.{name}")
