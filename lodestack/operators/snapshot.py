"""Provenance of removed snapshots: where their content is now, through chains of renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.functions import dates

#: Actions of a rename plan that move content (fixed values).
MOVING = ("move", "drop-source-duplicate")


def rename_map(plan: DataFrame, order: str | None = None) -> DataFrame:
    """source, destination of moves; the last row of a source counts, by column order if there is one."""
    moves = plan.filter(F.col("action").isin(*MOVING))
    last = F.max_by("destination", F.col(order)) if order else F.last("destination")
    return moves.groupBy("source").agg(last.alias("destination"))


def resolve(renames: DataFrame, most: int = 64) -> DataFrame:
    """source, current: where each source of a rename map ends, following chains.

    A path that has been passed isn't followed again, so a cycle ends where it began. Chains longer than most raise.
    """
    spark = renames.sparkSession
    renames.createOrReplaceTempView("_lodestack_renames")
    return spark.sql(f"""
        with recursive steps(origin, at, seen) max recursion level {most} as (
            select source, source, cast(array() as array<string>) from _lodestack_renames
            union all
            select s.origin, r.destination, array_append(s.seen, r.source)
            from steps s join _lodestack_renames r on s.at = r.source
            where not array_contains(s.seen, s.at)
        )
        select origin as source, max_by(at, size(seen)) as current from steps group by origin
    """)


def index(duplicates: DataFrame, manifest: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """sha256, current_path, historical_path, snapshot_date, bytes, relation of snapshots that were removed.

    The current path is the canonical path after renames if its content is there, else the only
    path with that content, else the canonical path as it was, else ''.
    """
    rows = duplicates.filter("reason = 'snapshot-identical'")
    if renames is not None:
        rows = rows.join(resolve(renames).withColumnRenamed("source", "canonical_path"), "canonical_path", "left")
    else:
        rows = rows.withColumn("current", F.lit(None).cast("string"))
    now = manifest.filter("sha256 <> '' and path <> ''").select("sha256", "path")
    wanted = rows.select("sha256").distinct()
    where = now.join(wanted, "sha256", "left_semi").groupBy("sha256").agg(F.count("*").alias("n"), F.collect_set("path").alias("paths"))
    found = rows.withColumn("current", F.coalesce("current", "canonical_path")).join(where, "sha256", "left")
    path = F.when(F.array_contains("paths", F.col("current")), F.col("current")).when(F.col("n") == 1, F.col("paths")[0]).when(F.array_contains("paths", F.col("canonical_path")), F.col("canonical_path")).otherwise("")
    out = found.select("sha256", path.alias("current_path"), F.col("duplicate_path").alias("historical_path"), dates.extract(F.col("duplicate_path")).alias("snapshot_date"), F.col("bytes").cast("long").alias("bytes"), F.lit("identical-snapshot").alias("relation"))
    return out.orderBy("current_path", "snapshot_date", "historical_path")


def index_summary(rows: DataFrame) -> DataFrame:
    """domain, snapshots, dated, missing_current; the most first."""
    domain = F.substring_index("historical_path", "/", 1).alias("domain")
    return rows.groupBy(domain).agg(F.count("*").alias("snapshots"), F.count_if(F.col("snapshot_date") != "").alias("dated"), F.count_if(F.col("current_path") == "").alias("missing_current")).orderBy(F.desc("snapshots"), "domain")
