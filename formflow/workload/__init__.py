"""Every operator as a query over the bound test tables, with its oracle SQL."""

from __future__ import annotations

from formflow.workload import flatten, growth, maintain, media, metadata, products, reports, state, views

_PARTS = (state, metadata, flatten, maintain, media, views, reports, growth, products)

QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
