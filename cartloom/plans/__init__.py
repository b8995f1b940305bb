"""Registered queries, one module per capability group."""

from importlib import import_module

MODULES = (
    "projection",
    "joins",
    "aggregates",
    "windows",
    "documents",
    "changes",
    "protection",
    "usage",
    "reviews",
    "files",
    "streams",
    "layout",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
