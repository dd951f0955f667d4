"""Names and paths."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffixes of two parts.
DOUBLE = (".tar.gz", ".tar.zst", ".tar.xz", ".geojson.gz", ".csv.gz", ".json.gz")


def _dashed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug(text: Column) -> Column:
    out = _dashed(F.lower(text))
    return F.when(out == "", F.lit("dataset")).otherwise(out)


def stable_name(name: Column) -> Column:
    return F.concat(slug(name), F.lit("-"), F.substring(F.sha2(name, 256), 1, 10))


@F.pandas_udf(T.StringType())
def _unaccented(text: pd.Series) -> pd.Series:
    def plain(s: str | None) -> str | None:
        return s if s is None or s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))

    return text.map(plain)


def normalized(text: Column) -> Column:
    """Lower case without accents, other characters as dashes; ASCII text never reaches Python."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), _dashed(F.lower(text))).otherwise(_dashed(F.lower(_unaccented(text))))


def leaf(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def depth(path: Column) -> Column:
    return F.size(F.filter(F.split(path, "/"), lambda p: p != ""))


def top_domain(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def parent(path: Column) -> Column:
    """The folder a path is in, `.` at the top."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit("."))


def parent_key(path: Column) -> Column:
    return F.when(path.contains("/"), normalized(parent(path))).otherwise(F.lit("."))


def is_ancestor(upper: Column, lower: Column) -> Column:
    return lower.startswith(F.concat(upper, F.lit("/")))


def ancestors(path: Column) -> Column:
    """All folders above a path, so that an ancestor join is an equality join on the exploded array."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).otherwise(F.array().cast("array<string>"))


def format_name(path: Column) -> Column:
    """Suffix of a file name in lower case, two parts for known pairs, `<no-ext>` if there is none."""
    name = F.lower(leaf(path))
    single = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)  # a dot at the start alone begins no suffix
    out = F.when(name.endswith(DOUBLE[0]), F.lit(DOUBLE[0]))
    for s in DOUBLE[1:]:
        out = out.when(name.endswith(s), F.lit(s))
    return out.otherwise(F.coalesce(F.nullif(single, F.lit("")), F.lit("<no-ext>")))


def gib(size: Column, digits: int = 3) -> Column:
    return F.format_string(f"%.{digits}f", size / F.lit(2.0**30))


def mib(size: Column, digits: int = 3) -> Column:
    return F.format_string(f"%.{digits}f", size / F.lit(2.0**20))


def natural_pass(name: Column) -> Column:
    """Sort key of log names: the base log first, pass logs by number, then by name."""
    number = F.regexp_extract(name, r"-pass(\d+)", 1)
    return F.struct(name.contains("-pass").alias("is_pass"), F.coalesce(number.try_cast("bigint"), F.lit(0)).alias("number"), name.alias("name"))
