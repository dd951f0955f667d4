"""JSON files as text: arrays, objects, lines and GeoJSON features, with what can be saved of cut files."""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import jsontext, sniff
from lodestack.sources.delimited import BAD, FILE
from lodestack.sources.files import encoding_of, head


def layout(path: str, gzipped: bool = False) -> str:
    """array, object, lines, empty or unknown, from the first 64 KiB."""
    raw = head(path, sniff.HEAD, gzipped)
    text = raw.decode(encoding_of(raw), "replace").lstrip("﻿").strip()
    if not text:
        return "empty"
    if text[0] == "[":
        return "array"
    if text[0] != "{":
        return "unknown"
    first = text.split("\n", 1)
    try:
        json.loads(first[0])
    except ValueError:
        return "object"
    return "lines" if len(first) > 1 and first[1].strip().startswith("{") else "object"


def _whole(spark: SparkSession, path: str | list[str], *more) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(*more, F.regexp_replace("value", "^﻿", "").alias("value"))


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """json: the items of a JSON array, null for JSON null. A file that isn't a whole array raises."""
    parts = jsontext.items(F.col("value"))
    good = F.when(parts.isNull(), F.raise_error(F.lit("not a whole JSON array"))).otherwise(parts)
    return _whole(spark, path).select(F.explode(good).alias("item")).select(F.when(F.col("item") != "null", F.col("item")).alias("json"))


def read_arrays(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Items of many files as read_array gives them: FILE, BAD (the file isn't a whole array), none (an array without items), json."""
    rows = _whole(spark, paths, F.col("_metadata.file_path").alias(FILE)).select(FILE, jsontext.items(F.col("value")).alias("items"))
    found = rows.select(FILE, F.col("items").isNull().alias(BAD), (F.size("items") < 1).alias("none"), F.explode_outer("items").alias("item"))
    return found.select(FILE, BAD, "none", F.when(F.col("item") != "null", F.col("item")).alias("json"))


def read_object(spark: SparkSession, path: str) -> DataFrame:
    """key, kind, item_index, json of a JSON object's members."""
    return jsontext.members(_whole(spark, path), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """json: one value a line, checked; blank lines are left out."""
    line = F.trim("value")
    valid = F.try_parse_json(line).isNotNull() | F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>").isNotNull()
    bad = F.raise_error(F.concat(F.lit("not a JSON line: "), F.substring(line, 1, 200)))
    return spark.read.text(path).filter(line != "").select(F.when(valid, line).otherwise(bad).alias("json"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """feature_json: the features of a GeoJSON collection. A file that isn't whole raises."""
    found = F.from_json("value", "struct<features:array<string>>")["features"]
    good = F.when(found.isNull(), F.raise_error(F.lit("not a whole feature collection"))).otherwise(found)
    return _whole(spark, path).select(F.explode(good).alias("feature_json"))


def salvaged(name: str, data: bytes, key: str | None = None) -> tuple[list[str], str | None]:
    """Items of a file's array (or of the array under key) up to where the text breaks, and what is wrong there."""
    decoder = json.JSONDecoder()
    raw = gzip.decompress(data) if name.endswith(".gz") else data
    text = raw.decode(encoding_of(raw[: 1 << 20]), "replace").lstrip("\ufeff")
    items: list[str] = []
    at = text.find(f'"{key}"') + len(key) + 2 if key else 0
    at = text.find("[", at) + 1
    try:
        if not at:
            raise ValueError("no array")
        while True:
            while at < len(text) and text[at] in " \t\r\n,":
                at += 1
            if at >= len(text):
                raise ValueError("the text ends within the array")
            if text[at] == "]":
                return items, None
            value, at = decoder.raw_decode(text, at)
            items.append(json.dumps(value, ensure_ascii=False, separators=(",", ":")))
    except ValueError as e:
        return items, str(e)


def salvage(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """json, error: items of an array (or of the array under key) up to where the text breaks.

    Each file is decoded in order by one task, as only that finds the place of the break; error, on
    the last row, says what is wrong there. Numbers and the order of keys stay as they are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items, error = salvaged(name, data, key)
                errors = [None] * len(items)
                if error is not None:
                    items, errors = [*items, None], [*errors, error]
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(errors, pa.string())], ["json", "error"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "json string, error string")
