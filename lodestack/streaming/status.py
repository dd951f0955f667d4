"""Streams over logs and folders: latest status of every source, and files not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest(stream: DataFrame, key: str, order: list[str], *values: str) -> DataFrame:
    """Values of the last row of each key so far; state is one row a key."""
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return stream.groupBy(key).agg(last).select(key, "last.*")


def run_latest(stream: DataFrame, key: str, order: list[str], values: list[str], output: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; changed keys of each batch are written to output/batch=N.

    A batch that is run again after a failure replaces its folder, so rows are never doubled.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    out = latest(stream, key, order, *values).writeStream.outputMode("update").foreachBatch(write)
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, output: str, key: str) -> DataFrame:
    """The newest row of each key over all batches."""
    rows = spark.read.parquet(output)
    columns = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "batch").alias("last")).select(key, "last.*")


def new_files(spark: SparkSession, folder: str, output: str, checkpoint: str, pattern: str = "*.parquet") -> StreamingQuery:
    """Append path, bytes, mtime of files that this checkpoint has not seen; contents aren't read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    rows = files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
    return rows.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
