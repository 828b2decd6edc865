"""Queries; importing this package registers all of them."""

from . import corpus, extraction, queries, recorded, scaling

__all__ = ["corpus", "extraction", "queries", "recorded", "scaling"]
