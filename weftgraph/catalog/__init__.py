"""Every operator as a query over the given tables."""

from __future__ import annotations

from importlib import import_module

from weftgraph.catalog.registry import ORACLE, QUERIES, Run

MODULES = ("graph_queries", "vector_queries", "text_queries", "hybrid_queries", "write_queries")


def _load() -> None:
    for module in MODULES:
        import_module(f"weftgraph.catalog.{module}")


def all_queries() -> dict[str, Run]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLE)
