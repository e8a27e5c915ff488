"""All queries of the road-safety library by name, with the SQL that tells the same result."""

from __future__ import annotations

from kerbline.plans import aggregates, analysis, cleaning, ingest, roads, spatial

QUERIES: dict = {}
SQL: dict = {}
for _part in (aggregates, cleaning, spatial, analysis, ingest, roads):
    QUERIES |= _part.QUERIES
    SQL |= _part.SQL
