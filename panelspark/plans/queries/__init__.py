"""Queries over the given tables, one per operator, each with the SQL of its expected result."""

from importlib import import_module

_MODULES = ("shaping", "panel_time", "member", "panel", "evaluation", "selection", "sampling", "learning")


def load_all() -> None:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
