"""PostgreSQL types: the Spark type of each, and the decoding of a text value into it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions import dates, ewkb, pgarray

# Type names by Spark type.
PLAIN: dict[str, T.DataType] = {
    **dict.fromkeys(("bool", "boolean"), T.BooleanType()),
    **dict.fromkeys(("int2", "smallint"), T.ShortType()),
    **dict.fromkeys(("int4", "integer", "serial", "serial4"), T.IntegerType()),
    **dict.fromkeys(("int8", "bigint", "bigserial", "serial8"), T.LongType()),
    **dict.fromkeys(("real", "float4"), T.FloatType()),
    **dict.fromkeys(("double precision", "float8", "float", "numeric", "decimal"), T.DoubleType()),
    **dict.fromkeys(("bytea",), T.BinaryType()),
    **dict.fromkeys(("date",), T.DateType()),
    **dict.fromkeys(("text", "varchar", "character varying", "char", "character", "bpchar", "uuid", "json", "jsonb", "inet", "cidr", "bit", "varbit", "bit varying"), T.StringType()),
}
CONSTRAINT = re.compile(r"\s+(?:constraint|not\s+null|null|default|primary\s+key|references|check|unique)\b", re.I)


class UnsupportedType(ValueError):
    """A type without a mapping, while falling back to text isn't allowed."""


def normalize(pg_type: str) -> str:
    return " ".join(pg_type.lower().split())


def declared_type(clause: str) -> str:
    """The type in an ADD COLUMN clause, without constraints."""
    clause = clause.strip()
    cut = CONSTRAINT.search(clause)
    return " ".join((clause[: cut.start()] if cut else clause).split())


def split_array(pg_type: str) -> tuple[str, int]:
    base, depth = normalize(pg_type), 0
    while base.endswith("[]"):
        base, depth = base[:-2].rstrip(), depth + 1
    return base, depth


def spark_type(pg_type: str, fallback: bool = False, time_type: bool = True) -> T.DataType:
    """Spark type of a declared type. Numbers wider than 38 digits and unknown types raise, or are text with fallback.

    numeric(p) has scale 0. Arrays of more than one dimension are refused when the plan is made.
    """
    base, depth = split_array(pg_type)
    if depth > 1:
        raise UnsupportedType(f"only one-dimensional arrays are supported: {pg_type}")
    if depth:
        return T.ArrayType(spark_type(base, fallback, time_type), True)
    bare = re.sub(r"\s*\([^)]*\)", "", base)
    if base.startswith("geometry"):
        return T.BinaryType()
    if (m := re.fullmatch(r"(?:numeric|decimal)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", base)) is not None:
        p, s = int(m[1]), int(m[2] or 0)
        if p <= 38 and s <= p:
            return T.DecimalType(p, s)
    elif bare.startswith("timestamptz") or bare == "timestamp with time zone":
        return T.TimestampType()
    elif bare in ("timestamp", "timestamp without time zone"):
        return T.TimestampNTZType()
    elif bare in ("time", "time without time zone") and time_type:
        return T.TimeType(6)
    elif bare in PLAIN:
        return PLAIN[bare]
    if fallback:
        return T.StringType()
    raise UnsupportedType(f"no mapping for type {pg_type!r}")


def decode(value: Column, pg_type: str, fallback: bool = False, time_type: bool = True) -> Column:
    """Typed value of an unescaped text value; null stays null, a malformed value raises."""
    base, depth = split_array(pg_type)
    target = spark_type(pg_type, fallback, time_type)
    if depth:
        return F.transform(pgarray.parse(value), lambda x: decode(x, base, fallback, time_type))
    if base.startswith("geometry"):
        return ewkb.to_wkb(value)
    if isinstance(target, T.BooleanType):
        word = F.lower(F.trim(value))
        bad = F.raise_error(F.concat(F.lit("invalid boolean "), value)).cast("boolean")
        return F.when(value.isNull(), None).when(word.isin("t", "true", "1"), True).when(word.isin("f", "false", "0"), False).otherwise(bad)
    if isinstance(target, T.BinaryType):
        return F.when(value.startswith("\\x"), F.unhex(F.substring(value, F.lit(3), F.length(value)))).otherwise(F.encode(value, "ISO-8859-1"))
    if isinstance(target, T.DateType):
        return dates.iso(value).cast("date")
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return dates.timestamp(value, target)
    if isinstance(target, T.StringType):
        return value
    return value.cast(target)
