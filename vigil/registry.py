"""All registered queries and their oracles (import this, not the parts)."""

from __future__ import annotations

from . import catalog, catalog_io, catalog_ml, catalog_monitor, catalog_rows  # noqa: F401

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE
