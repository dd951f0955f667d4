"""One-dimensional array literals of PostgreSQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Possessive, so that Java doesn't recurse at every character of a long element.
ELEMENT = r',((?:"(?:[^"\\]++|\\[\s\S])*+"|[^,"\\]++|\\[\s\S])*+)'


def parse(text: Column) -> Column:
    """Array of string; unquoted NULL is null; malformed literals raise."""
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    bare = F.regexp_replace(inner, r"\\[\s\S]", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    bad = ~(text.startswith("{") & text.endswith("}")) | (F.length(text) < 2) | bare.contains("\\") | (quotes % 2 != 0)

    def element(x: Column) -> Column:
        quoted = F.regexp_replace(x, r"\\[\s\S]", "").contains('"')
        value = F.regexp_replace(x, r'\\([\s\S])|"', "$1")
        return F.when((F.upper(value) == "NULL") & ~quoted, None).otherwise(value)

    parts = F.transform(F.regexp_extract_all(F.concat(F.lit(","), inner), F.lit(ELEMENT), F.lit(1)), element)
    error = F.raise_error(F.concat(F.lit("malformed array literal: "), F.substring(text, 1, 100)))
    return F.when(text == "{}", F.array().cast("array<string>")).when(bad, error).otherwise(parts)


def render(values: Column) -> Column:
    """The literal of an array of string."""
    def element(x: Column) -> Column:
        text = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.when(x.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit('"'), text, F.lit('"')))

    return F.concat(F.lit("{"), F.array_join(F.transform(values, element), ","), F.lit("}"))
