"""Registered queries; importing this package fills the registry."""

from . import registry  # noqa: F401
from . import url_queries, page_queries, ingest_queries, select_queries, accounting_queries, log_queries, routing_queries, score_queries, maintenance_queries, stream_queries, migrate_queries, more_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
HEADLINE = registry.HEADLINE
