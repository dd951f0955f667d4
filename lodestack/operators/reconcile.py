"""Latest status of raw sources in migration logs, and what to try again."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.functions import names

# Classes of log statuses, in the order they are reported.
CLASSES = {"done": "complete", "skip": "complete", "partial": "partial", "failed": "missing", "unsupported": "ignored"}
REPORTED = ("complete", "partial", "missing", "ignored", "unknown")


def status_class(status: Column) -> Column:
    out = None
    for s, c in CLASSES.items():
        out = (F if out is None else out).when(status == s, c)
    return out.otherwise("unknown")


def reason(*columns: str) -> Column:
    """The first of the columns that isn't null or empty, else ''."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(""))


def top_level(log: DataFrame, raw_root: str) -> DataFrame:
    """Records of files below raw_root, without those of archive members."""
    prefix = raw_root.rstrip("/") + "/"
    return log.filter(F.col("source").isNotNull() & F.col("status").isNotNull() & ~F.col("source").contains("!") & F.col("source").startswith(prefix))


def latest(log: DataFrame, key: str, order: list[str], *values: str) -> DataFrame:
    """Values of the last row of each key in the given order; aggregated before the shuffle, no window."""
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return log.groupBy(key).agg(last).select(key, "last.*")


def classify(log: DataFrame, raw_root: str, sizes: DataFrame | None = None) -> DataFrame:
    """raw_path, class, bytes, gib, reason of every source's latest record; with sizes (source, bytes), of existing files only."""
    rows = top_level(log, raw_root).withColumn("why", reason("error", "reason", "kind"))
    last = latest(rows, "source", ["log", "at"], "status", "why")
    last = last.join(sizes, "source") if sizes is not None else last.withColumn("bytes", F.lit(None).cast("long"))
    path = F.substring("source", F.lit(len(raw_root.rstrip("/")) + 2), F.length("source"))
    return last.select(path.alias("raw_path"), status_class(F.col("status")).alias("class"), "bytes", names.gib(F.col("bytes"), 6).alias("gib"), F.col("why").alias("reason")).orderBy("raw_path")


def totals(classified: DataFrame) -> DataFrame:
    """class, files, bytes, gib in the order of REPORTED."""
    place = F.array_position(F.array(*map(F.lit, REPORTED)), F.col("class"))
    sums = classified.groupBy("class").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return sums.withColumn("gib", names.gib(F.col("bytes"))).orderBy(place)


def retry_queue(log: DataFrame, raw_root: str, statuses: Iterable[str], sizes: DataFrame, kinds: Iterable[str] | None = None, min_size: int = 0) -> DataFrame:
    """source, status, kind, bytes of existing sources whose latest status is chosen; `ignored` means `unsupported`."""
    chosen = ["unsupported" if s == "ignored" else s for s in statuses]
    last = latest(top_level(log, raw_root).withColumn("kind", F.coalesce("kind", F.lit(""))), "source", ["log", "at"], "status", "kind")
    out = last.filter(F.col("status").isin(chosen))
    if kinds is not None:
        out = out.filter(F.col("kind").isin(list(kinds)))
    return out.join(sizes, "source").filter(F.col("bytes") >= min_size).orderBy("source")
