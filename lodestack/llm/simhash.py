"""SimHash near-duplicates by pigeonhole blocks.

Two fingerprints that differ in at most `distance` bits agree on at least blocks - distance of
`blocks` blocks, so each fingerprint is keyed by every such choice of blocks and only
fingerprints with an equal key are compared. Equal fingerprints are one class before that, so
copies are never paired. A bucket gives the edges of a spanning forest of its links, fewer than
its fingerprints, instead of all pairs; components come from one task's union of those edges while
they are few, else from label propagation with pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.work import join_by_key, located, materialise, partitions

SEED = 42
#: Fingerprints of one bucket that are compared as they are; larger buckets are split again.
DIRECT = 2048
#: Mean fingerprints a bucket beyond which more, longer keys are used.
LOAD = 64
#: Edges, of 16 bytes each, that one task unites.
LOCAL = 1_000_000
#: Files of a round's table of labels: a file for so many links, but some at least.
ROWS_A_FILE, MIN_FILES = 50_000, 8


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bits set in over half of the XXH64 values of word shingles, repeats included; 0 if there are no words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    a, b = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    parts = (np.array([digest(joined[x:y], SEED) for x, y in zip(a[i : i + 65536], b[i : i + 65536])], "<u8") for i in range(0, n, 65536))
    return majority(parts, n)


def majority(parts: Iterable[np.ndarray], n: int) -> int:
    """Bits set in over half of n values of 64 bits, which come in parts."""
    ones = np.zeros(64, np.int64)
    for h in parts:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()))


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(values)], ["doc_id", "file", "row", "fp"])

    return run


def block_choices(distance: int, count: int) -> tuple[int, list[tuple[int, ...]]]:
    """Number of blocks, and the choices of blocks that form a key, for so many fingerprints."""
    for blocks in range(distance + 1, distance + 5):
        held = blocks - distance
        if count <= LOAD << (64 // blocks * held) or blocks == distance + 4:
            return blocks, list(combinations(range(blocks), held))
    raise AssertionError


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    cut = [64 * i // blocks for i in range(blocks + 1)]
    return list(zip(cut, cut[1:]))


def spanning(values: np.ndarray, distance: int, mask: int = (1 << 64) - 1) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of all links among distinct values.

    Up to DIRECT values are compared with each other. More are split by blocks of the bits in
    mask, those on which they may still differ: linked values agree on one of distance + 1
    blocks, so no link is lost, and the pieces lie apart from each other's bits until they are small.
    """
    n = len(values)
    bits = [i for i in range(64) if mask >> i & 1]
    if n > DIRECT and len(bits) > distance:
        out = []
        for k in range(distance + 1):
            part = sum(1 << b for b in bits[k :: distance + 1])
            key = values & np.uint64(part)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            for group in np.split(order, cuts):
                if len(group) > 1:
                    out += [(int(group[a]), int(group[b])) for a, b in spanning(values[group], distance, mask & ~part)]
        return out
    edges, left = [], np.arange(n)
    while len(left):
        found, left = [int(left[0])], left[1:]
        for at in found:
            if not len(left):
                break
            near = np.bitwise_count(values[left] ^ values[at]) <= distance
            if near.any():
                new = left[near].tolist()
                edges += [(at, x) for x in new]
                found += new
                left = left[~near]
    return edges


def _bucket_edges(distance: int):
    def edges(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        out_a, out_b = [], []
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a == 1:
                continue
            v = fp[a:b].view(np.uint64)
            if b - a <= 256 and (np.bitwise_count(v[:, None] ^ v[None, :]) <= distance).sum() == b - a:
                continue
            for x, y in spanning(v, distance):
                out_a.append(int(fp[a + x]))
                out_b.append(int(fp[a + y]))
        return pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:  # sorted by key; the last key of a batch may go on in the next
            key, fp = np.concatenate([key, np.asarray(batch.column(0))]), np.concatenate([fp, np.asarray(batch.column(1))])
            if len(key) and key[0] != key[-1]:
                cut = int(np.searchsorted(key, key[-1]))
                yield edges(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield edges(key, fp)

    return run


def links(spark: SparkSession, classes: DataFrame, count: int, distance: int) -> DataFrame:
    """Edges (a, b) of spanning forests of the links between distinct fingerprints fp."""
    blocks, choices = block_choices(distance, count)
    bounds = block_bounds(blocks)
    keys = []
    for i, choice in enumerate(choices):
        key, width = F.lit(i).cast("long"), 0
        for k in choice:
            low, high = bounds[k]
            key = F.shiftleft(key, high - low).bitwiseOR(F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1)))
            width += high - low
        keys.append(key)
    rows = classes.select("fp", F.explode(F.array(*keys)).alias("key")).select("key", "fp")
    return rows.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(_bucket_edges(distance), "a long, b long")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """v, label of a graph's edges, all in one task."""
    parts = [[np.asarray(b.column(i)) for i in (0, 1)] for b in batches]
    a, b = (np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in (0, 1))
    v, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(v))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b, label[a], label[b]):
            np.minimum.at(new, x, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    for i in range(0, len(v), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(v[i : i + 100_000]), pa.array(v[label[i : i + 100_000]])], ["v", "label"])


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """Vertices of edges (a, b) with the smallest vertex of their component: v, label.

    Up to LOCAL distinct edges, counted first, one task unites them in memory. Beyond, in rounds of: the
    least of the labels of its neighbours and of its label's own label. Every round is a written
    table, so lost executors cost one round. The number of rounds grows with the logarithm of
    the diameter; if `most` didn't do, it raises instead of returning part.
    """
    spark = edges.sparkSession
    edges = materialise(edges.select("a", "b").distinct(), "edges")
    if edges.count() <= LOCAL:
        return materialise(edges.coalesce(1).mapInArrow(_united, "v long, label long"), "labels")
    ways = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    both = materialise(edges.select(ways.alias("e")).select("e.u", "e.v").distinct(), "links")
    count = both.count()
    files = min(partitions(spark), max(MIN_FILES, count // ROWS_A_FILE))  # small tables in few files
    labels = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("label")).coalesce(files), "labels")
    for _ in range(most):
        near = both.join(labels, "v").groupBy(F.col("u").alias("v")).agg(F.min("label").alias("near"))
        hop = labels.groupBy("label").agg(F.count("*").alias("n")).join(labels.select(F.col("v").alias("label"), F.col("label").alias("jump")), "label")
        jumped = join_by_key(labels, hop, "label", "n", count)  # most vertices of a large component have one label
        step = jumped.join(near, "v").select("v", F.least("jump", "near").alias("new"), "label")
        step = materialise(step.select("v", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")).coalesce(files), "labels")
        labels = step.select("v", "label")
        if step.filter("moved").isEmpty():
            return labels
    raise RuntimeError(f"labels still move after {most} rounds")


def near_duplicates(spark: SparkSession, docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, stays, and its file and row.

    Null and empty texts have no words: their fingerprint is zero and links like any other. One
    row of each component stays, that with the smallest doc_id (null doc_ids last, ties by
    file and row). An empty table gives no rows; columns but doc_id and text are not read.
    """
    rows = located(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", "file", "row")
    prints = materialise(rows.mapInArrow(_fingerprints(shingle), "doc_id long, file string, row long, fp long"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "row")).alias("first")
    classes = materialise(prints.groupBy("fp").agg(first, F.count("*").alias("n")), "classes")
    return kept_rows(prints, classes, components(links(spark, classes.select("fp"), classes.count(), distance)))


def kept_rows(prints: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of prints with the component of their fingerprint; found names components of more than one fingerprint."""
    total = prints.count()
    known = classes.join(found, classes["fp"] == found["v"], "left").select("fp", "first", "n", F.coalesce("label", "fp").alias("label"))
    known = materialise(known, "known")
    least = known.groupBy("label").agg(F.min("first").alias("least"), F.count("*").alias("members"))
    known = join_by_key(known, least, "label", "members", total)
    named = materialise(known.select("fp", "n", F.col("least.doc_id").alias("component_id"), F.col("least.file").alias("keep_file"), F.col("least.row").alias("keep_row")), "components")
    stays = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    joined = join_by_key(prints, named, "fp", "n", total)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", stays.alias("stays"), "file", "row")
