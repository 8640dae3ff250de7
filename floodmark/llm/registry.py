"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from importlib import import_module

from floodmark.catalog.registry import Query

MODULES = (
    "piece_codec", "exact_dedup", "suffix_dedup", "near_dedup", "window_dedup",
    "quality", "chat", "secrets", "personal", "packing", "token_files", "importance", "part_codes",
)


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Import every operator module and collect its QUERY name, function and SQL."""
    queries, oracles = {}, {}
    for name in MODULES:
        module = import_module(f"floodmark.llm.{name}")
        queries[module.NAME] = module.query
        if module.SQL is not None:
            oracles[module.NAME] = module.SQL
    return queries, oracles
