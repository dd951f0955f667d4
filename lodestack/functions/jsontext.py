"""JSON kept as text: members and items in their order, without inferring a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(value: Column) -> Column:
    """A JSON string literal of text."""
    return F.regexp_extract(F.to_json(F.array(value)), r"^\[([\s\S]*)\]$", 1)


def items(text: Column) -> Column:
    """Items of a JSON array as array of JSON text; null if it isn't one, or is cut.

    Both parses are of the same text: one keeps each item's text, the other tells strings apart.
    """
    raw, kinds = F.from_json(text, "array<string>"), F.from_json(text, "array<variant>")
    return F.zip_with(raw, kinds, lambda v, k: _text(v, F.schema_of_variant(k)))


def _text(value: Column, kind: Column) -> Column:
    return F.when(kind == "STRING", quoted(value)).when(kind.isNull() | (kind == "VOID"), F.lit("null")).otherwise(value)


def members(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """Members of JSON objects: key, kind (array-item, empty-array, object, scalar), item_index, json.

    Rows whose text is no object raise.
    """
    text = F.col(column)
    raw, kinds = F.from_json(text, "map<string,string>"), F.from_json(text, "map<string,variant>")
    good = F.when(raw.isNull(), F.raise_error(F.lit("not a JSON object"))).otherwise(raw)
    pairs = rows.select(*keep, F.posexplode(F.arrays_zip(F.map_keys(good).alias("key"), F.map_values(raw).alias("text"), F.transform(F.map_values(kinds), lambda v: F.schema_of_variant(v)).alias("kind"))).alias("at", "m"))
    pairs = pairs.select(*keep, "at", F.col("m.key").alias("key"), F.col("m.text").alias("text"), F.col("m.kind").alias("of"))
    array = F.col("of").startswith("ARRAY")
    inner = F.when(array, items(F.col("text")))
    kind = F.when(array & (F.size(inner) > 0), "array-item").when(array, "empty-array").when(F.col("of").startswith("OBJECT"), "object").otherwise("scalar")
    out = pairs.select(*keep, "at", "key", kind.alias("kind"), F.when(F.size(inner) > 0, inner).otherwise(F.array(F.when(array, F.lit("[]")).otherwise(_text(F.col("text"), F.col("of"))))).alias("values"))
    out = out.select(*keep, "at", "key", "kind", F.posexplode("values").alias("i", "json"))
    return out.select(*keep, "key", "kind", F.when(F.col("kind") == "array-item", F.col("i").cast("long")).alias("item_index"), "json")


def null_token(value: Column) -> Column:
    """CSV cells that mean null."""
    return F.when(value.isin("", "null", "NULL"), None).otherwise(value)


def lines(text: Column) -> Column:
    """Physical lines of a text with their terminators (LF, CRLF, CR)."""
    parts = F.split(text, r"(?<=\n)|(?<=\r)(?!\n)")
    return F.filter(parts, lambda x: x != "")
