"""Shared work folder, materialised tables and joins that survive one very frequent key."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys above this many rows, and above 1/HOT_PARTS of all rows, are joined by broadcast.
HOT_ROWS = 250
HOT_PARTS = 100_000
#: Words of 64 bits in the table that sieve broadcasts, whatever the number of members.
SIEVE_WORDS = 1 << 18
BATCH = "4m"
#: What tasks leave in a Python worker for later ones of the same kind.
KEPT: dict[str, dict] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only where the setting is absent, as in local tests, a local folder is set instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="lodestack-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lodestack/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends, lost executors cost nothing.

    Batches for Python are cut at BATCH bytes, since JVM and Python worker hold some of them each.
    """
    path = fresh_path(df.sparkSession, name)
    with settings(df.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], uses: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, in workers that outlive their stage: drops what other kinds of tasks left, and gives back freed memory at the end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, held in KEPT.items():
            if kind != uses:
                held.clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps it otherwise
            trim(0)

    return whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_by_key(left: DataFrame, right: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of left with right (unique on key; column n counts the key's rows in left).

    Keys with more than max(HOT_ROWS, total / HOT_PARTS) rows are at most HOT_PARTS by
    arithmetic, so exactly those rows of right are broadcast; the rest is shuffled, and no
    remaining key is frequent. Nothing is dropped or sampled. left is read twice.
    """
    bound = max(HOT_ROWS, total // HOT_PARTS)
    hot, cold = right.filter(F.col(n) > bound), right.filter(F.col(n) <= bound)
    in_hot = left.join(F.broadcast(hot), key)
    in_cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("shuffle_hash"), key)
    return in_hot.unionByName(in_cold.select(in_hot.columns))


def sieve(rows: DataFrame, members: DataFrame, *keys: str) -> DataFrame:
    """rows without most of those whose keys (not null) no member has; none that a member has is dropped.

    A Bloom filter with one hash function: a broadcast table of at most SIEVE_WORDS words. The
    more members, the more other rows pass; a join still decides.
    """
    bit = F.pmod(F.xxhash64(*keys), F.lit(64 * SIEVE_WORDS))
    one = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    words = members.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_at")).agg(F.bit_or(one).alias("_word"))
    found = rows.withColumn("_bit", bit).join(F.broadcast(words), F.shiftright("_bit", 6) == F.col("_at"))
    return found.filter(F.col("_word").bitwiseAND(one) != 0).select(*rows.columns)


def in_files(docs: DataFrame) -> DataFrame:
    """docs, or where it isn't read straight from Parquet files, docs written to the shared folder."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index").schema  # noqa: B018  resolves them
        return docs
    except AnalysisException:
        return materialise(docs, "rows")


def located(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, and where each row stands: file, row (unique even for repeated rows)."""
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    return in_files(docs).select(*columns, *place)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs (see in_files) without the rows that dropped names by file and row; all columns."""
    names = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    rows = docs.select(*names, F.col("_metadata.file_path").alias("_at_file"), F.col("_metadata.row_index").alias("_at_row"))
    gone = dropped.select(F.col("file").alias("_at_file"), F.col("row").alias("_at_row"))
    return rows.join(gone.hint("shuffle_hash"), ["_at_file", "_at_row"], "left_anti").select(*names)
