"""Registered queries of the core and their SQL."""

from seqloom.queries import catalogue, ingest, packed_and_keys, similarity, training

_MODULES = (catalogue, ingest, similarity, training, packed_and_keys)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
FLAGSHIP = "proxy_neighbors"
