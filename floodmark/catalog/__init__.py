"""Registered queries: each operator run over whole driver tables, with an equivalent SQL text where one exists."""

from __future__ import annotations

from importlib import import_module

from floodmark.catalog.registry import ORACLES, QUERIES

for _name in ("scans", "profiles", "features", "splits", "windows", "joins", "detectors", "quality", "decisions", "streams", "facts", "suites", "sketched", "chains"):
    import_module(f"floodmark.catalog.{_name}")

__all__ = ["ORACLES", "QUERIES"]
