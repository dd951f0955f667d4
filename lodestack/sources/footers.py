"""Parquet footers and file digests, read by executors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.sources.files import filesystem

FOOTER = "path string, bytes long, rows long, row_groups int, columns int, schema_hash string, geo boolean, sha256 string, error string"
CHUNK = 16 << 20


def inspect(path: str, checksum: bool) -> tuple:
    """Footer facts of one file, and its SHA-256 if asked for; a broken file gives its error."""
    system, inside = filesystem(path.replace("dbfs:/", "/dbfs/"))
    try:
        size = system.get_file_info(inside).size
        with system.open_input_file(inside) as f:
            meta = pq.read_metadata(f)
            schema = meta.schema.to_arrow_schema()
            digest = None
            if checksum:
                h = hashlib.sha256()
                f.seek(0)
                while part := f.read(CHUNK):
                    h.update(part)
                digest = h.hexdigest()
        text = schema.remove_metadata().to_string(show_field_metadata=False, show_schema_metadata=False)
        return path, size, meta.num_rows, meta.num_row_groups, meta.num_columns, hashlib.sha256(text.encode()).hexdigest(), b"geo" in (meta.metadata or {}), digest, None
    except Exception as e:
        return path, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"


def footers(paths: DataFrame, checksum: bool = False) -> DataFrame:
    """Facts of every path (column path); files are opened by the tasks, only footers unless checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [inspect(p, checksum) for p in batch.column(0).to_pylist()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split()[0] for c in FOOTER.split(", ")])

    return paths.select("path").mapInArrow(run, FOOTER)


def parquet_files(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, mtime of the Parquet files below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
