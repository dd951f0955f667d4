"""Byte-limited shards by extendible hashing, in DataFrame operations alone.

A document's key is a 64-bit hash. A shard is a prefix of the hash's bits; a bucket over the
byte limit is split on its next bit, and nothing else is. Bytes are first summed by a prefix of
`depth` bits; the directory is then found on those sums, whose number depends on the number of
shards, not on that of documents. Only buckets still too large at that depth are
summed again by more bits, until all fit or the hash is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.work import materialise

#: Bits added in each pass over buckets that are still too large, and bits beyond the mean number of shards.
MORE, BEYOND = 8, 6
BITS = 64
#: Directory rows (about 100 bytes each) up to which the directory is broadcast.
SMALL = 100_000
#: Byte limit of a shard where the caller sets none: a 64th of all bytes, but within these bounds.
LEAST, MOST = 64 << 10, 16 << 20


def prefix(hashed: Column, depth: int | Column) -> Column:
    """The first depth bits as text, which is also the shard's name."""
    return F.substring(F.lpad(F.bin(hashed), BITS, "0"), 1, depth) if isinstance(depth, int) else F.lpad(F.bin(hashed), BITS, "0").substr(F.lit(1), depth)


def leaves(sums: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Shortest prefixes of low to high bits, of those in sums (prefix of high bits, bytes), that fit.

    Columns prefix, bytes, documents, fits; a prefix of high bits that doesn't fit is returned with fits
    false. Each prefix of high bits is under exactly one of them.
    """
    every = F.explode(F.transform(F.sequence(F.lit(low), F.lit(high)), lambda d: F.col("prefix").substr(F.lit(1), d)))
    nodes = sums.select(every.alias("prefix"), "bytes", "documents").groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("documents").alias("documents"))
    nodes = nodes.withColumn("fits", F.col("bytes") <= limit)
    parents = nodes.select(F.col("prefix").alias("parent"), F.col("fits").alias("parent_fits"))
    joined = nodes.withColumn("parent", F.expr("substring(prefix, 1, length(prefix) - 1)")).join(parents, "parent", "left")
    below = (F.length("prefix") == low) | ~F.coalesce("parent_fits", F.lit(False))
    return joined.filter(below & (F.col("fits") | (F.length("prefix") == high))).select("prefix", "bytes", "documents", "fits")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only what has been counted and is within SMALL rows; beyond, the join shuffles."""
    return F.broadcast(df) if rows <= SMALL else df


def directory_of(rows: DataFrame, limit: int) -> DataFrame:
    """The directory for rows (key, bytes): prefix, bytes, documents, fits."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + BEYOND))
    low, inside, done = 0, rows, None
    while True:
        sums = inside.groupBy(prefix(F.col("key"), depth).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("documents"))
        found = materialise(leaves(sums, low, depth, limit), "shard-directory")
        if depth == BITS:
            return found if done is None else done.unionByName(found)
        done = found.filter("fits") if done is None else done.unionByName(found.filter("fits"))
        open_ = found.filter("not fits").select(F.col("prefix").alias("top"))
        if not (n := open_.count()):
            return done
        inside = rows.join(_small(open_, n), prefix(F.col("key"), depth) == F.col("top")).drop("top")
        low, depth = depth + 1, min(BITS, depth + MORE)


def place(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """rows (with key) and their shard, depth, shard_bytes, shard_documents, oversize.

    A row's shard is one of its key's prefixes, so the join is an equality on the prefix of each
    depth that the directory uses, of which there are at most 65.
    """
    used = sorted(r[0] for r in directory.select(F.length("prefix")).distinct().collect())
    if not used:
        used = [0]
    named = directory.select(F.col("prefix").alias("shard"), F.col("bytes").alias("shard_bytes"), F.col("documents").alias("shard_documents"), (~F.col("fits")).alias("oversize"))
    tried = rows.withColumn("depth", F.explode(F.array(*map(F.lit, used)))).withColumn("shard", prefix(F.col("key"), F.col("depth")))
    return tried.join(_small(named, directory.count()), "shard")


def keyed(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), size.alias("bytes"))


def limit_for(rows: DataFrame) -> int:
    """A 64th of all bytes, at least LEAST and at most MOST: small tables are split too."""
    return max(LEAST, min(MOST, (rows.agg(F.sum("bytes")).first()[0] or 0) // 64))


def shards(spark: SparkSession, docs: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per document: doc_id, bytes, shard (bits), depth, shard_bytes, shard_documents, oversize.

    limit is a shard's most bytes; None takes limit_for. bytes is the text's length in UTF-8; null
    text counts as empty. The key hashes doc_id and text, so that rows of one doc_id can part;
    equal rows share a shard. oversize marks the only
    shards that exceed the limit: those whose documents all have one key, such as a single
    document above it. An empty table gives no rows; columns but doc_id and text are not read.
    """
    rows = materialise(keyed(docs), "shard-keys")
    return place(rows, directory_of(rows, limit or limit_for(rows))).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_documents", "oversize")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, limit: int = 16 << 20) -> DataFrame:
    """Write doc_id and text as Parquet below path/shard=<bits>, one folder a shard; returns the directory."""
    directory = materialise(directory_of(materialise(keyed(docs), "shard-keys"), limit), "shard-directory")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("key"))
    placed = place(rows, directory).select("doc_id", "text", F.concat(F.lit("s"), "shard").alias("shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
    return directory
