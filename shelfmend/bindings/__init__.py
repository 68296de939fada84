"""Operators bound to the test data."""

from importlib import import_module

MODULES = ("reports", "missing", "cut", "moves", "states")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
