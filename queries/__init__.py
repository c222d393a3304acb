"""Registered queries and the SQL they are compared with, one module per family."""

from queries import links, search, stores, texts, vectors

_FAMILIES = (texts, links, search, vectors, stores)

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
