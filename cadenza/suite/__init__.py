"""All registered queries; importing a module registers its queries."""

from cadenza.suite import audits, catalogue, clustering, genres, insights, search, streams, windows  # noqa: F401
from cadenza.suite.registry import REGISTRY

__all__ = ["REGISTRY"]
