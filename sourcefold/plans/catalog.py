"""All queries of the curation operators, and their SQL."""

from . import checked, curation, decided, evidence, more, page_places, places, responses, reviewing, scalars, selecting  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
