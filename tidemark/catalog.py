"""All queries of the library, by name, each with the SQL an independent engine can check it by."""

from __future__ import annotations

from tidemark.plans import features, models, registry, statistics, texts, views

QUERIES: dict = {}
SQL: dict = {}
for _part in (features, registry, views, texts, statistics, models):
    QUERIES |= _part.QUERIES
    SQL |= _part.SQL
