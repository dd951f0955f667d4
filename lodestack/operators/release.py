"""Release of a corpus: one canonical entry for each content, and its duplicates with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks in paths that the rules look for.
EXPORTS = ("export au format", "/fichier csv", "/fichier json")
SNAPSHOT_TREES = ("vigieau/", "repertoire-national/")
EXPORT_NAMES = ("export au format", "fichier csv", "fichier json")


def _any(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m)
    return out


def path_penalty(path: Column) -> Column:
    """Sort key of a path, least preferred last: marks of technical folders, archives and generic exports, then depth, length and the path."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")

    def many(test) -> Column:
        return F.size(F.filter(parts, test))

    archive = many(lambda p: F.lower(p).contains("-zip-") | F.lower(p).endswith(".zip") | F.lower(p).contains("-7z-") | F.lower(p).endswith(".7z"))
    technical = many(lambda p: p.endswith(".staging") | p.startswith(".") | p.isin("_tmp", "tmp"))
    generic = _any(F.lower(path), EXPORTS).cast("int")
    return F.struct((technical * 100 + archive * 10 + generic).alias("marks"), F.size(parts).alias("depth"), F.length(path).alias("length"), path.alias("path"))


def duplicate_reason(canonical: Column, duplicate: Column) -> Column:
    """Why two paths hold the same content; the first rule that holds decides."""
    c, d = F.lower(canonical), F.lower(duplicate)

    def zipped(p: Column) -> Column:
        return p.contains("-zip-") | p.contains(".zip/")

    out = F.when(c.contains(SNAPSHOT_TREES[0]) & d.contains(SNAPSHOT_TREES[0]), "snapshot-identical")
    out = out.when(c.contains(SNAPSHOT_TREES[1]) & d.contains(SNAPSHOT_TREES[1]), "snapshot-identical")
    out = out.when(zipped(c) != zipped(d), "archive-vs-standalone")
    out = out.when(_any(c, EXPORT_NAMES) | _any(d, EXPORT_NAMES), "duplicate-export")
    same_name = F.element_at(F.split(canonical, "/"), -1) == F.element_at(F.split(duplicate, "/"), -1)
    return out.when(same_name, "dataset-alias").otherwise("exact-duplicate")


def canonical(entries: DataFrame, penalty: Column | None = None) -> DataFrame:
    """sha256, and of its least penalised entry path, bytes, partial; copies: all rows of the content.

    min_by is aggregated before the shuffle, so a content with very many copies costs a row a task.
    """
    key = path_penalty(F.col("path")) if penalty is None else penalty
    best = F.min_by(F.struct("path", "bytes", "partial"), key).alias("best")
    return entries.groupBy("sha256").agg(best, F.count("*").alias("copies")).select("sha256", "best.*", "copies")


def duplicates(entries: DataFrame) -> DataFrame:
    """sha256, canonical_path, duplicate_path, bytes, reason of every entry that isn't its content's canonical one."""
    kept = canonical(entries).filter("copies > 1").select("sha256", F.col("path").alias("canonical_path"))
    pairs = entries.join(kept, "sha256").filter(F.col("path") != F.col("canonical_path"))
    return pairs.select("sha256", "canonical_path", F.col("path").alias("duplicate_path"), "bytes", duplicate_reason(F.col("canonical_path"), F.col("path")).alias("reason"))


def summary(entries: DataFrame) -> DataFrame:
    """One row: source_files, release_files, removed_files, duplicate_groups, source_bytes, release_bytes, removed_bytes, partial_files."""
    groups = entries.groupBy("sha256").agg(F.count("*").alias("n"), F.sum("bytes").alias("all_bytes"), F.min_by("bytes", path_penalty(F.col("path"))).alias("kept_bytes"), F.count_if("partial").alias("partials"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("source_files"), F.count("*").alias("release_files"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed_files"), F.count_if(F.col("n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum("all_bytes"), F.lit(0)).alias("source_bytes"), F.coalesce(F.sum("kept_bytes"), F.lit(0)).alias("release_bytes"), F.coalesce(F.sum(F.col("all_bytes") - F.col("kept_bytes")), F.lit(0)).alias("removed_bytes"),
        F.coalesce(F.sum("partials"), F.lit(0)).alias("partial_files"),
    )
