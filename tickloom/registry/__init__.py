"""Every operator as a runnable query over the given tables, with the SQL that must give the same rows."""
from __future__ import annotations

from importlib import import_module

from .base import ORACLES, QUERIES

MODULES = ["market", "quotes_bi", "logs_media", "metrics_quality", "learning", "risk_options", "io", "streams"]

for _m in MODULES:
    import_module(f"{__name__}.{_m}")

__all__ = ["QUERIES", "ORACLES"]
