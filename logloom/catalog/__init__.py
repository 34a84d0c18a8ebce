"""All registered queries."""

from logloom.catalog import q_enrich, q_grok, q_ingest, q_mutate, q_predicates, q_refdata, q_sources, q_streams  # noqa: F401
from logloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
