"""Text lines, opaque bytes, Parquet, N-Triples and SpreadsheetML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import jsontext, ntriples


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_number from 1, text with its line end."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(jsontext.lines(F.col("value"))).alias("at", "text"))
    return lines.select((F.col("at") + 1).cast("long").alias("line_number"), "text")


def read_blob(spark: SparkSession, path: str) -> DataFrame:
    """source_name, data: one row a file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_name"), F.col("content").alias("data"))


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    return ntriples.triples(spark.read.text(path))


def read_spreadsheetml(spark: SparkSession, path: str) -> DataFrame:
    """row_json: cells of each row as a JSON array of strings; a cell without data is an empty string."""
    rows = spark.read.option("rowTag", "Row").schema("Cell array<struct<Data:string>>").xml(path)
    cells = F.transform("Cell", lambda c: F.coalesce(c["Data"], F.lit("")))
    return rows.select(F.to_json(cells).alias("row_json"))


def file_sizes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes, mtime of all files below a folder; contents aren't read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return read.load(path).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
