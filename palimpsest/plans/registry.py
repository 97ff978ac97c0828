"""All registered queries of the library and their SQL."""

from __future__ import annotations

from palimpsest.plans import answers, documents, fields, flows, knowledge, layouts, origins, relational, states  # noqa: F401  (most register with documents)


def queries() -> dict:
    return relational.QUERIES | documents.QUERIES


def oracle_sql() -> dict[str, str]:
    return relational.SQL | documents.SQL
