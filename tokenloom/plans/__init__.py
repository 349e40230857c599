"""All registered queries."""

from tokenloom.plans import backoff, batches, language, learned, preparation, sequences, streams, vectors
from tokenloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
