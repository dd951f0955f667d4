"""Dates and times in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso(value: Column) -> Column:
    """YYYY/MM/DD and YYYY.MM.DD with dashes, the first space as T."""
    dashed = F.regexp_replace(value, r"^(\d{4})[./](\d{2})[./](\d{2})", "$1-$2-$3")
    return F.regexp_replace(dashed, "^([^ ]*) ", "$1T")


def timestamp(value: Column, kind: T.DataType) -> Column:
    """Timestamp of text; second 60 is the next instant; without a zone a zoned type means UTC."""
    text = iso(value)
    leap = text.rlike(r"T\d{2}:\d{2}:60")
    if isinstance(kind, T.TimestampType):
        zone = F.when(text.rlike(r"T.*(?:Z|[+-]\d{2}(?::?\d{2})?)$"), F.lit("")).otherwise(F.lit("Z"))
        text = F.concat(F.when(text.contains("T"), text).otherwise(F.concat(text, F.lit("T00:00:00"))), zone)
    repaired = F.regexp_replace(text, r"(?<=T\d{2}:\d{2}:)60", "59")
    second = F.expr("interval 1 second")
    return F.when(leap, repaired.cast(kind) + second).otherwise(text.cast(kind))


def extract(path: Column) -> Column:
    """First 20YY-MM-DD (or with underscores) anywhere, else first 20YYMMDD, as YYYY-MM-DD; else ''."""
    dashed, compact = r"(?<!\d)(20\d{2})[-_](\d{2})[-_](\d{2})(?!\d)", r"(?<!\d)(20\d{2})(\d{2})(\d{2})(?!\d)"

    def found(pattern: str) -> Column:
        return F.nullif(F.concat_ws("-", *[F.nullif(F.regexp_extract(path, pattern, k), F.lit("")) for k in (1, 2, 3)]), F.lit(""))

    return F.coalesce(found(dashed), found(compact), F.lit(""))
