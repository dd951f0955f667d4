"""Delimited text: dialect, all-string and inferred reading, and a form that keeps ragged rows."""

from __future__ import annotations

import csv
import gzip
import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions.jsontext import null_token
from lodestack.sources.files import encoding_of, head

SAMPLE = 256 << 10
#: How Spark reads records as strings, and the columns that come before those of many files.
STRINGS = {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}
FILE, BAD = "_lodestack_file", "_lodestack_bad"


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def dialect(path: str, gzipped: bool = False) -> tuple[list[str], str]:
    """Header and delimiter from the first 256 KiB; a tab, else a comma, if sniffing fails."""
    text = head(path, SAMPLE, gzipped).decode("utf-8-sig", "replace")
    if not text:
        return [], ","
    try:
        delimiter = csv.Sniffer().sniff(text, delimiters=",;\t|").delimiter
    except csv.Error:
        delimiter = "\t" if "\t" in text.splitlines()[0] else ","
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter), []), delimiter


def read_strings(spark: SparkSession, path: str, delimiter: str | None = None, gzipped: bool = False) -> DataFrame:
    """All columns as string, values over several lines; "", null and NULL (quoted or not) are null. Ragged rows raise when read."""
    header, found = dialect(path, gzipped)
    if not header:
        raise ValueError(f"no header in {path}")
    raw = spark.read.schema(_strings(header)).options(**STRINGS, sep=delimiter or found, mode="FAILFAST").csv(path)
    return raw.select(*[null_token(F.col(f"`{c}`")).alias(c) for c in header])


def read_strings_of(spark: SparkSession, paths: list[str], header: list[str], delimiter: str) -> DataFrame:
    """Rows of files with one header, as read_strings gives them: first FILE and BAD (the row doesn't fit the header), then the columns."""
    raw = spark.read.schema(_strings([*header, BAD])).options(**STRINGS, sep=delimiter, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD).csv(paths)
    return raw.select(F.col("_metadata.file_path").alias(FILE), F.col(BAD).isNotNull().alias(BAD), *[null_token(F.col(f"`{c}`")).alias(c) for c in header])


def read_inferred(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """Types inferred from the values."""
    _, found = dialect(path)
    return spark.read.options(header="true", multiLine="true", sep=delimiter or found, escape='"', inferSchema="true").csv(path)


def read_lossless(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """row_json: each record, the header too, as a JSON array; rows may have any number of cells.

    Quotes can hold line ends, so one file is one task; folders are read by a task a file.
    """
    sep = delimiter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = gzip.decompress(data) if name.endswith(".gz") else data
                text = raw.decode(encoding_of(raw[: 1 << 20]), "replace")
                if sep:
                    d = sep
                else:
                    try:
                        d = csv.Sniffer().sniff(text[:SAMPLE], delimiters=",;\t|").delimiter
                    except csv.Error:
                        d = "\t" if "\t" in text[: text.find("\n") + 1 or None] else ","
                rows = (json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in csv.reader(io.StringIO(text, newline=""), delimiter=d))
                part: list[str] = []
                for r in rows:
                    part.append(r)
                    if len(part) == 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(part)], ["row_json"])
                        part = []
                if part:
                    yield pa.RecordBatch.from_arrays([pa.array(part)], ["row_json"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "row_json string")


def read_any(spark: SparkSession, path: str, gzipped: bool = False) -> tuple[DataFrame, str]:
    """Strings if every row fits the header, else rows as JSON; and the representation's name.

    Whether it fits is found by one pass over the rows, without keeping them.
    """
    try:
        out = read_strings(spark, path, gzipped=gzipped)
        out.write.format("noop").mode("overwrite").save()
        return out, "csv"
    except ValueError:  # no header
        pass
    except Exception as e:
        if "MALFORMED_CSV_RECORD" not in str(e):
            raise
    return read_lossless(spark, path), "lossless-csv-row-json"
