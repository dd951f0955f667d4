"""COPY text rows: fields and escapes, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Possessive, so that Java doesn't recurse at every character of a long field.
FIELD = r"\t((?:[^\\\t]++|\\[\s\S]|\\$)*+)"
TOKEN = r"\\(?:[0-7]{1,3}|x[0-9A-Fa-f]{1,2}|[\s\S])|[^\\]+|\\$"
# The letters that escape a control character.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def split_fields(line: Column) -> Column:
    """Raw fields of a logical line: array of string, cut at tabs that aren't escaped."""
    return F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(FIELD), F.lit(1))


def code_point(value: Column) -> Column:
    """The character of a code point below 65536."""
    return F.decode(F.unhex(F.lpad(F.hex(value), 4, "0")), "UTF-16BE")


def _token(t: Column) -> Column:
    rest = F.substring(t, 2, 3)
    out = F.when(~t.startswith("\\") | (F.length(t) == 1), t)
    for letter, character in ESCAPES.items():
        out = out.when(t == "\\" + letter, F.lit(character))
    out = out.when(t.rlike(r"^\\[0-7]"), code_point(F.conv(rest, 8, 10).cast("long")))
    out = out.when(t.rlike(r"^\\x[0-9A-Fa-f]"), code_point(F.conv(F.substring(t, 3, 2), 16, 10).cast("long")))
    return out.otherwise(F.substring(t, 2, 1))


def unescape(field: Column) -> Column:
    r"""Value of a raw field: \N is null, escapes are resolved; octal and hex give code points."""
    slow = F.array_join(F.transform(F.regexp_extract_all(field, F.lit(TOKEN), F.lit(0)), _token), "")
    return F.when(field == "\\N", None).when(~field.contains("\\"), field).otherwise(slow)


def parse_row(line: Column) -> Column:
    """Unescaped fields of a logical line."""
    return F.transform(split_fields(line), unescape)


def escape(value: Column) -> Column:
    """The raw field of a value, for writing COPY text."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for letter, character in ESCAPES.items():
        out = F.replace(out, F.lit(character), F.lit("\\" + letter))
    return F.coalesce(out, F.lit("\\N"))


def checked(fields: Column, columns: int, where: str) -> Column:
    """fields, or an error if their number isn't that of the columns."""
    message = F.concat(F.lit(f"{where}: expected {columns} fields, found "), F.size(fields).cast("string"))
    return F.when(F.size(fields) == columns, fields).otherwise(F.raise_error(message))


def trailing_backslashes(text: Column) -> Column:
    r"""How many backslashes end a physical line; an odd number carries it on into the next."""
    return F.length(F.regexp_extract(text, r"(\\*)$", 1))
