"""Registered queries of the catalog operators."""

from __future__ import annotations

from gneiss.plans import catalog_queries

QUERIES = dict(catalog_queries.QUERIES)
ORACLES = dict(catalog_queries.ORACLES)
