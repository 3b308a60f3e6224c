"""All registered queries."""

from packetmill.plans import gold, ocr, reports, silver, streams, verification, worklist  # noqa: F401
from packetmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
