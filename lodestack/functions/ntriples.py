"""N-Triples lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"^([^ ]+) ([^ ]+) (.+) \.$"


def kind(term: Column) -> Column:
    return F.when(term.startswith("<"), "iri").when(term.startswith("_:"), "bnode").when(term.startswith('"'), "literal").otherwise("other")


def triples(lines: DataFrame, column: str = "value") -> DataFrame:
    """subject, predicate, object, object_kind of each line that isn't blank; malformed lines raise."""
    text = F.trim(F.regexp_replace(column, r"[\r\n]+$", ""))
    kept = lines.select(text.alias("line")).filter("line <> ''")
    ok = F.col("line").rlike(LINE)
    part = [F.when(ok, F.regexp_extract("line", LINE, k)).otherwise(F.raise_error(F.concat(F.lit("not an N-Triples line: "), F.substring("line", 1, 200)))) for k in (1, 2, 3)]
    return kept.select(part[0].alias("subject"), part[1].alias("predicate"), part[2].alias("object"), kind(part[2]).alias("object_kind"))
