"""Registered queries: one per operator of the inventory, each with the
DuckDB SQL that restates it over the same parquet tables (the oracle).

Every query reads the driver's tables (through the derived log stores of
``sources.fixtures``) over their whole extent."""
from __future__ import annotations

from .registry import REGISTRY, oracle_sql, queries  # noqa: F401
from . import reads, decodes, encodes, progress, streams  # noqa: F401,E402  (register)
