"""Manifest of a Parquet corpus: footers and digests, reused where a file hasn't changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.sources import footers


def reusable(checksum: bool) -> Column:
    """An earlier entry (columns old_*) holds if size and time are the same, and a digest is there if one is asked for."""
    same = (F.col("bytes") == F.col("old_bytes")) & (F.col("mtime") == F.col("old_mtime"))
    return F.coalesce(same & (F.lit(not checksum) | (F.col("old_sha256") != "")), F.lit(False))


def split_known(files: DataFrame, previous: DataFrame, checksum: bool) -> tuple[DataFrame, DataFrame]:
    """files (path, bytes, mtime) as (rows of previous that hold, files to inspect)."""
    old = previous.select("path", *[F.col(c).alias(f"old_{c}") for c in previous.columns if c != "path"])
    joined = files.join(old, "path", "left").withColumn("reuse", reusable(checksum))
    known = joined.filter("reuse").select("path", "bytes", "mtime", *[F.col(f"old_{c}").alias(c) for c in previous.columns if c not in ("path", "bytes", "mtime")])
    return known, joined.filter(~F.col("reuse")).select("path", "bytes", "mtime")


def build(spark: SparkSession, root: str, checksum: bool = False, previous: DataFrame | None = None) -> DataFrame:
    """path (relative), bytes, mtime, rows, row_groups, columns, schema_hash, geo, partial, sha256, error of all Parquet files below root."""
    files = footers.parquet_files(spark, root)
    relative = F.regexp_replace("path", "^.*?" + root.rstrip("/").replace("file://", "") + "/", "")
    files = files.withColumn("full", F.col("path")).withColumn("path", relative)
    names = ("rows", "row_groups", "columns", "schema_hash", "geo", "sha256", "error")
    partial = F.col("path").endswith(".partial.parquet").alias("partial")
    known = None
    todo = files
    if previous is not None:
        known, rest = split_known(files.drop("full"), previous, checksum)
        todo = files.join(rest.select("path"), "path", "left_semi")
    slices = max(1, spark.sparkContext.defaultParallelism)
    seen = footers.footers(todo.select(F.col("full").alias("path")).repartition(slices), checksum).select(F.col("path").alias("full"), *names)
    out = todo.join(seen, "full").select("path", "bytes", "mtime", *names, partial)
    return (out if known is None else out.unionByName(known.select(out.columns))).orderBy("path")


def totals(manifest: DataFrame) -> DataFrame:
    """One row: files, bytes, rows, schemas (distinct), partial_files, errors."""
    return manifest.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.countDistinct("schema_hash").alias("schemas"), F.count_if("partial").alias("partial_files"), F.count_if(F.col("error").isNotNull()).alias("errors"))


def dataset_totals(manifest: DataFrame) -> DataFrame:
    """dataset (first folder), files, rows, bytes, geo_files, with a rollup row (null) over all."""
    return manifest.rollup(F.substring_index("path", "/", 1).alias("dataset")).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count_if("geo").alias("geo_files"))
