"""Registered query plans (each a DataFrame over the driver tables) and their DuckDB oracles."""
from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["q_core", "q_models", "q_encode", "q_diag", "q_audit", "q_blend", "q_ml", "q_explain", "q_score"]


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise


__all__ = ["QUERIES", "ORACLE", "load_all"]
