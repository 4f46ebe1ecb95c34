"""Registered queries; importing the modules registers them."""

from docloom.plans import ingestion, learned, registry, reports, webpages

__all__ = ["ingestion", "learned", "registry", "reports", "webpages"]
