"""All registered queries."""

from __future__ import annotations

import importlib

from arborframe.plans.registry import ORACLE, QUERIES

MODULES = ("queries_measure", "queries_clean", "queries_tiling", "queries_terrain", "queries_assign", "queries_geometry", "queries_tables", "queries_stems", "queries_assemble", "queries_jobs")

for _name in MODULES:
    importlib.import_module(f"arborframe.plans.{_name}")

__all__ = ["ORACLE", "QUERIES"]
