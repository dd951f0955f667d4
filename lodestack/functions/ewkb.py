"""Geometry payloads: EWKB as hexadecimal text to WKB bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_wkb(text: Column) -> Column:
    """WKB without the SRID. Z, M and bounding-box flags, and payloads that are cut, raise.

    All flags stand in one byte of the type word: the last in little endian, the first in big.
    """
    h = F.lower(F.regexp_replace(text, r"^\\x", ""))
    order = F.substring(h, 1, 2)
    flags = F.conv(F.when(order == "01", F.substring(h, 9, 2)).otherwise(F.substring(h, 3, 2)), 16, 10).cast("int")
    clean = F.lpad(F.lower(F.hex(flags.bitwiseAND(0xDF))), 2, "0")
    kind = F.when(order == "01", F.concat(F.substring(h, 3, 6), clean)).otherwise(F.concat(clean, F.substring(h, 5, 6)))
    out = F.when(~h.rlike("^(?:[0-9a-f]{2})*+$"), F.raise_error(F.lit("geometry payload is not hexadecimal")))
    out = out.when(F.length(h) < 10, F.raise_error(F.lit("geometry payload too short")))
    out = out.when(~order.isin("00", "01"), F.raise_error(F.concat(F.lit("invalid byte order "), order)))
    out = out.when(flags.bitwiseAND(0xD0) != 0, F.raise_error(F.lit("geometry with Z, M or bounding box is not supported")))
    out = out.when(flags.bitwiseAND(0x20) == 0, F.unhex(h))
    out = out.when(F.length(h) < 18, F.raise_error(F.lit("geometry flags an SRID but holds none")))
    return out.otherwise(F.unhex(F.concat(order, kind, F.substring(h, F.lit(19), F.length(h)))))


def canonical_type(name: str) -> str:
    """Name of a geometry type as GeoParquet writes it."""
    # Fixed values of the GeoParquet specification.
    names = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
    return {n.upper(): n for n in names}.get(name.strip().upper(), name)
