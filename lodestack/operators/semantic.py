"""Rollups of a duplicate plan (sha256, canonical_path, duplicate_path, bytes, reason)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.functions import names

#: Reasons whose folders are compared (fixed values).
ALIAS_REASONS = ("dataset-alias", "exact-duplicate", "duplicate-export")


def _rollup(plan: DataFrame, key: Column, name: str) -> DataFrame:
    sums = plan.groupBy(key.alias(name)).agg(F.count("*").alias("duplicate_files"), F.sum("bytes").alias("bytes"))
    return sums.withColumn("gib", names.gib(F.col("bytes"))).orderBy(F.desc("bytes"), name)


def by_reason(plan: DataFrame) -> DataFrame:
    return _rollup(plan, F.col("reason"), "reason")


def by_domain(plan: DataFrame) -> DataFrame:
    return _rollup(plan, names.top_domain(F.col("duplicate_path")), "domain")


def both(plan: DataFrame) -> DataFrame:
    """Both rollups and the total in one pass: reason, domain (null where summed over), files, bytes."""
    rows = plan.select("reason", names.top_domain(F.col("duplicate_path")).alias("domain"), "bytes")
    reason, domain = F.col("reason"), F.col("domain")
    return rows.groupingSets([[reason], [domain], []], reason, domain).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def alias_pairs(plan: DataFrame, reasons: tuple[str, ...] = ALIAS_REASONS) -> DataFrame:
    """Folders that hold each other's content: reason, files, bytes, mib, canonical_parent, duplicate_parent."""
    keys = [F.col("reason"), names.parent(F.col("canonical_path")).alias("canonical_parent"), names.parent(F.col("duplicate_path")).alias("duplicate_parent")]
    sums = plan.filter(F.col("reason").isin(*reasons)).groupBy(*keys).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    out = sums.select("reason", "files", "bytes", names.mib(F.col("bytes")).alias("mib"), "canonical_parent", "duplicate_parent")
    return out.orderBy(F.desc("bytes"), "reason", "canonical_parent", "duplicate_parent")


def snapshot_groups(plan: DataFrame) -> DataFrame:
    """Identical snapshots: sha256, canonical_path, logical_versions (with the canonical one), duplicate_bytes, duplicate_mib, duplicate_paths."""
    groups = plan.filter("reason = 'snapshot-identical'").groupBy("sha256", "canonical_path")
    sums = groups.agg((F.count("*") + 1).alias("logical_versions"), F.sum("bytes").alias("duplicate_bytes"), F.array_join(F.sort_array(F.collect_list("duplicate_path")), ";").alias("duplicate_paths"))
    return sums.select("sha256", "canonical_path", "logical_versions", "duplicate_bytes", names.mib(F.col("duplicate_bytes")).alias("duplicate_mib"), "duplicate_paths").orderBy(F.desc("duplicate_bytes"), "canonical_path")
