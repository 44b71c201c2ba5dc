"""Ready-made queries over the driver tables, each with equivalent SQL where there is one."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("market_queries", "merge_queries", "valuation_queries", "text_queries", "feed_queries", "store_queries")


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
