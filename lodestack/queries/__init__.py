"""Registered queries of the reference operators over the driver's tables, with their SQL."""

from lodestack.queries import catalog, decoders, roundtrips

__all__ = ["catalog", "decoders", "roundtrips"]
