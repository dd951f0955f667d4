"""Exact deduplication by a stateful stream.

Digests stream through keyed state on disk (RocksDB) that never expires. For each digest it
retains the digest, the stable identifier that stays (largest doc_id), the content locator of
that row (file and row index) and the number of rows. Rows whose digest is hit by another row
are then checked byte for byte against the located content; of other rows, nearly all texts stay
where they are, held back by a filter of fixed size. A digest that two texts share is split into
exact groups. Only DataFrame and Structured Streaming operations are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.work import fresh_path, join_by_key, located, materialise, settings, sieve

#: Rows of one digest that are checked in one task at most, about.
CHECKED = 1000
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def absorb(spark: SparkSession, landing: str, checkpoint: str) -> None:
    """Stream every file of landing that the state has not seen yet into the state.

    Called again with the same checkpoint after more files have landed, it reads just those; a
    lost executor or driver resumes from the checkpoint.
    """
    rows = spark.readStream.schema("doc_id long, digest binary, file string, row long").parquet(landing)
    state = rows.groupBy("digest").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    with settings(spark, STATE):
        stream = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state retains: digest, keep_id, keep_file, keep_row, n."""
    with settings(spark, STATE):
        read = spark.read.format("statestore").load(checkpoint)
    keep, n = (f"value.{f}" for f in read.schema["value"].dataType.names)
    return read.select(
        F.col("key.digest").alias("digest"), F.col(f"{keep}.doc_id").alias("keep_id"), F.col(f"{keep}.file").alias("keep_file"), F.col(f"{keep}.row").alias("keep_row"), F.col(n).alias("n")
    )


def dedup(spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256)) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its file and row.

    Texts are equal when identical; null counts as empty. The row with the largest doc_id
    stays; of rows that repeat that doc_id, one stays; null doc_ids rank lowest. Very long texts are only
    hashed and compared; an empty table gives no rows; columns but doc_id and text are not read.
    digest must give a hexadecimal string of even length; equal digests of unequal texts are told apart.
    """
    base = fresh_path(spark, "exact-dedup")
    source = located(docs, "doc_id", "text")
    source = source.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), "file", "row")
    source.select("doc_id", F.unhex(digest(F.col("text"))).alias("digest"), "file", "row").write.parquet(f"{base}/landing")
    absorb(spark, f"{base}/landing", f"{base}/state")
    landing, state = spark.read.parquet(f"{base}/landing"), materialise(state_rows(spark, f"{base}/state"), "exact-dedup-state")
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    single = state.filter("n = 1").select(F.col("keep_id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), F.lit(True).alias("kept"), sha, F.col("keep_file").alias("file"), F.col("keep_row").alias("row"))

    members = join_by_key(landing, state.filter("n > 1"), "digest", "n", landing.count())
    members = materialise(members, "exact-dedup-members")
    hits = sieve(source.select("file", "row", "text"), members, "file", "row").join(members.hint("shuffle_hash"), ["file", "row"])
    parts = F.ceil(F.col("n") / CHECKED).cast("int")
    hits = materialise(hits.withColumn("salt", F.pmod(F.xxhash64("file", "row"), parts).cast("int")), "exact-dedup-hits")
    content = hits.filter("file = keep_file and row = keep_row").select("digest", F.col("text").alias("content"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    checked = hits.join(content.hint("shuffle_hash"), ["digest", "salt"]).withColumn("same", F.col("text") == F.col("content"))
    checked = materialise(checked.select("doc_id", "file", "row", "digest", "keep_id", "keep_file", "keep_row", "n", "same", F.when(~F.col("same"), F.col("text")).alias("text")), "exact-dedup-checked")
    strays = checked.filter("not same")
    if strays.isEmpty():
        return single.unionByName(_grouped(checked, sha))
    fewer = strays.groupBy("digest").agg(F.count("*").alias("less"))
    same = checked.filter("same").join(fewer, "digest", "left").withColumn("n", F.col("n") - F.coalesce("less", F.lit(0)))
    keeps = strays.groupBy("digest", "text").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "file", "row")).alias("k"), F.count("*").alias("n"))
    apart = strays.drop("keep_id", "keep_file", "keep_row", "n").join(keeps, ["digest", "text"]).withColumns({"keep_id": F.col("k.doc_id"), "keep_file": F.col("k.file"), "keep_row": F.col("k.row")})
    return single.unionByName(_grouped(same, sha)).unionByName(_grouped(apart, sha))


def _grouped(rows: DataFrame, sha: Column) -> DataFrame:
    stays = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return rows.select("doc_id", "keep_id", F.col("n").alias("group_size"), stays.alias("kept"), sha, "file", "row")


#: The same rows in DuckDB.
SQL = """
with t as (select doc_id, sha256(coalesce(text, '')) as text_sha256, coalesce(text, '') as body from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from t window w as (partition by body)
"""
