"""Token store of directly addressable codes.

An id is cut into bytes. Level 0 holds every id's low byte; a bitmap tells which ids go on,
and level k+1 holds the next byte of just those. A rank directory (ones before each block of
512 bits) finds an id's place on the next level, so any token or range of tokens is read
without decoding what stands before it.

A segment is one binary value: header, document table (id, token count), levels. Segments are
rows of a Parquet table, so they are written and committed by Spark on any file system and a
lost executor's segments are written again. Column part counts up in document order, and
start is the number of ids of the part before the segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.token_ids import encoder, text_groups, tokenizer_path
from lodestack.llm.work import fresh_path, partitions

MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_TOKENS = 1 << 18
SEGMENTS = "part int, segment int, start long, n_tokens long, n_docs int, payload binary"
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Level:
    """One chunk level: bytes, and, but for the last, a continuation bitmap with its ranks."""

    def __init__(self, codes: np.ndarray, bits: np.ndarray | None = None, ranks: np.ndarray | None = None):
        self.codes, self.bits, self.ranks = codes, bits, ranks

    @classmethod
    def of(cls, values: np.ndarray) -> tuple[Level, np.ndarray]:
        """The level of little-endian uint32 values, and what goes on to the next."""
        codes, on = values.view(np.uint8)[::4].copy(), values > 255
        if not on.any():
            return cls(codes), values[:0]
        bits = np.packbits(on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        ranks = np.concatenate([[0], ONES[bits].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32).cumsum()]).astype("<u4")
        return cls(codes, bits, ranks), values[on] >> np.uint32(8)

    def rank(self, i: int) -> int:
        """Ones before bit i."""
        block, rest = divmod(i, BLOCK)
        at = block * BLOCK // 8
        ones = int(self.ranks[block]) + int(ONES[self.bits[at : at + rest // 8]].sum())
        return ones + (bin(int(self.bits[at + rest // 8]) & ((1 << rest % 8) - 1)).count("1") if rest % 8 else 0)

    def on(self, a: int, b: int) -> np.ndarray:
        first = a // 8
        return np.unpackbits(self.bits[first : -(-b // 8)], bitorder="little")[a - first * 8 : b - first * 8].astype(bool)


class Segment:
    """Ids of consecutive documents in directly addressable codes."""

    def __init__(self, levels: list[Level], doc_ids: list[int | None], counts: np.ndarray):
        self.levels, self.doc_ids, self.counts = levels, doc_ids, counts
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    @classmethod
    def build(cls, doc_ids: list[int | None], counts: list[int], values: np.ndarray) -> Segment:
        """From the ids of all documents in a row, and how many each has."""
        levels: list[Level] = []
        while len(values) or not levels:
            level, values = Level.of(values)
            levels.append(level)
        return cls(levels, doc_ids, np.array(counts, np.int64))

    def __getitem__(self, i: int) -> int:
        """Any token, by one byte and one rank a level."""
        if not 0 <= i < len(self.levels[0].codes):
            raise IndexError(i)
        out, shift = 0, 0
        for level in self.levels:
            out |= int(level.codes[i]) << shift
            if level.bits is None or not int(level.bits[i >> 3]) >> (i & 7) & 1:
                break
            i, shift = level.rank(i), shift + 8
        return out

    def range(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b-1: on each level they are neighbours, found by two ranks."""
        level = self.levels[0]
        out = level.codes[a:b].astype(np.uint32)
        where = None  # places of the tokens that reach the level, None: all
        for k, below in enumerate(self.levels[1:], 1):
            on = level.on(a, b)
            where = np.flatnonzero(on) if where is None else where[on]
            if not len(where):
                break
            a = level.rank(a)
            b, level = a + len(where), below
            out[where] |= level.codes[a:b].astype(np.uint32) << np.uint32(8 * k)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.starts[k]), int(self.starts[k + 1]))

    def to_bytes(self) -> bytes:
        known = np.array([i is not None for i in self.doc_ids], np.uint8)
        out = [MAGIC, struct.pack("<IQI", len(self.doc_ids), len(self.levels[0].codes), len(self.levels)), known.tobytes(), np.array([i or 0 for i in self.doc_ids], "<i8").tobytes(), self.counts.astype("<i8").tobytes()]
        for x in self.levels:
            bits = b"" if x.bits is None else x.bits.tobytes()
            out += [struct.pack("<QQ", len(x.codes), len(bits)), x.codes.tobytes(), bits, b"" if x.bits is None else x.ranks.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Segment:
        if raw[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n_docs, _, n_levels = struct.unpack_from("<IQI", raw, 4)
        at = 20

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        known, ids, counts, levels = take("u1", n_docs), take("<i8", n_docs), take("<i8", n_docs), []
        for _ in range(n_levels):
            n_codes, n_bits = map(int, take("<u8", 2))
            codes, bits = take("u1", n_codes), take("u1", n_bits)
            levels.append(Level(codes, bits, take("<u4", n_bits * 8 // BLOCK + 1)) if n_bits else Level(codes))
        return cls(levels, [int(i) if k else None for k, i in zip(known, ids)], counts)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode documents (doc_id, text), append end_id to each, write segments in ascending doc_id order.

    Null text counts as empty, a null doc_id comes first, repeated doc_ids follow one another
    ordered by text hash, an empty table gives no segments, other columns are ignored,
    a text of more than 2 GB, which neither Arrow nor Parquet holds as one value, raises. A segment ends with
    the document that fills it; a document is never cut. Text is shuffled once, by ranges.
    """
    model = tokenizer_path(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, done = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        ids: list[bytes] = []
        size = 0

        def segment() -> Segment:
            return Segment.build(doc_ids, [len(x) // 4 for x in ids], np.frombuffer(b"".join(ids), "<u4"))

        def flush() -> pa.RecordBatch:
            nonlocal made, done, doc_ids, ids, size
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([made], pa.int32()), pa.array([done], pa.int64()), pa.array([size], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([segment().to_bytes()], pa.binary())],
                ["part", "segment", "start", "n_tokens", "n_docs", "payload"],
            )
            made, done, doc_ids, ids, size = made + 1, done + size, [], [], 0
            return out

        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in text_groups(texts):
                for key, raw in zip(keys[a:b], encoder(model).encode(texts.slice(a, b - a))):
                    doc_ids.append(key)
                    ids.append(raw + tail)
                    size += len(ids[-1]) // 4
                    if size >= segment_tokens:
                        yield flush()
        if ids:
            yield flush()

    n = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the segments alone: doc_id, start, n_tokens, ids_crc32.

    The only thing gathered on the driver is one total for each part, of which there are as
    many as shuffle partitions when the store was written.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    base, total = {}, 0
    for row in sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[row["part"]], total = total, total + row["n"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Segment.from_bytes(row["payload"])
                starts = s.starts[:-1] + (base[row["part"]] + row["start"])
                ids = memoryview(s.range(0, int(s.starts[-1])).astype("<u4").tobytes())
                at = (s.starts * 4).tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids, pa.int64()), pa.array(starts), pa.array(s.counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("part", "start", "payload").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_at(spark: SparkSession, path: str, place: int) -> int:
    """Any token of the whole store: one segment is read, and no block in it is decoded."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    if place < 0 or place >= sum(r["n"] for r in totals):
        raise IndexError(place)
    for row in totals:
        if place < row["n"]:
            break
        place -= row["n"]
    hit = segments.filter((F.col("part") == row["part"]) & (F.col("start") <= place) & (F.col("start") + F.col("n_tokens") > place)).first()
    return Segment.from_bytes(bytes(hit["payload"]))[place - hit["start"]]


def op8(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = fresh_path(spark, "token-store")
    write_store(docs, path, tokenizer)
    return read_store(spark, path)
