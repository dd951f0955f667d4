"""TSV catalogs and JSONL logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import names

MANIFEST = "path string, bytes long, rows long, row_groups int, columns int, schema_hash string, partial string, sha256 string"
LOG = "time string, status string, source string, output string, kind string, rows long, bytes long, error string, reason string"


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """All columns as string; a required column that is missing raises."""
    out = spark.read.options(sep="\t", header="true", quote='"', escape='"', multiLine="true").csv(path)
    if missing := sorted(set(required) - set(out.columns)):
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return out.fillna("")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256, partial; an entry without a digest raises."""
    rows = read_tsv(spark, path, ("path", "bytes", "sha256", "partial"))
    digest = F.trim("sha256")
    some = F.when(digest != "", digest).otherwise(F.raise_error(F.concat(F.lit("manifest entry without SHA-256: "), "path")))
    return rows.select("path", F.col("bytes").cast("long").alias("bytes"), some.alias("sha256"), F.col("partial").isin("1", "true", "True").alias("partial"))


def write_tsv(df: DataFrame, path: str) -> None:
    """One TSV file in the order of df, put in place as a whole. For catalogs, not for data: the rows pass through the driver."""
    import csv
    import io

    from lodestack.sources.files import write_atomically

    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter="\t", lineterminator="\n")
    w.writerow(df.columns)
    for r in df.toLocalIterator():
        w.writerow(["" if v is None else v for v in r])
    write_atomically(path, out.getvalue().encode())


def read_logs(spark: SparkSession, *paths: str) -> DataFrame:
    """Records of JSONL logs with their order: log (rank of the file: base log, then passes by number), at.

    A line that isn't JSON raises; blank lines are skipped.
    """
    rows = spark.read.schema(LOG + ", _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(list(paths))
    rows = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    bad = F.when(F.trim("_bad") != "", F.raise_error(F.concat(F.lit("invalid JSON in "), "file", F.lit(": "), F.substring("_bad", 1, 200))))
    return rows.withColumn("_bad", bad).filter("_bad is null").select(*[c.split()[0] for c in LOG.split(", ")], names.natural_pass(F.col("file")).alias("log"), F.struct("block", "at").alias("at"))
