"""Near copies by SimHash and by the Jaccard similarity of word shingles, without losing a pair.

Sets have SimHash fingerprints (bits set in over half of their elements); those that differ in at
most DISTANCE bits are found by pigeonhole blocks and linked as candidates, as in simhash.py. Most
pairs near the limit differ in more bits, so candidates that SimHash misses are added from the
elements themselves, where it has not linked the sets already. All candidates are compared exactly.

Two sets with a similarity of at least 4/5 share one of their leading elements, the first
n - ceil(4n/5) + 1 in any common order, so only sets with an equal leading element are
candidates. The order puts frequent shingles last, by a table of BINS counters over all
documents; the table changes how many candidates there are, never which pairs are found.

Keys are dealt by ranges, which split the most frequent ones. The sets of a key are compared by
fingerprints of their parities: bits that differ are at most elements that differ, and those are
at most a ninth of both sizes together. Very frequent keys, and those that go on in another
task, are chained by size instead, which adds candidates. So a key gives fewer edges than it has
sets. Elements that are before a pair's first common one, in either set, can't be common, so
a pair counts only under a key that leaves enough behind it in both. In each component of that graph the sets are made again from the texts and compared
exactly, where they share a leading element. Components of more than BLOCK sets go through tasks
of bounded size: blocks by themselves, with a few sets of the component in all of them, then the
sets outside the largest part found against every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.simhash import SEED, components, kept_rows, links, majority
from lodestack.llm.work import frugal, in_files, join_by_key, located, materialise, partitions, sieve

SHINGLE = 5
#: Bits of 64 in which SimHash fingerprints of linked sets differ at most.
DISTANCE = 6
#: Counters of the table that orders shingles, and counters a row of it.
BINS = 1 << 22
CHUNK = 1 << 12
#: Most sets, and most shingles, that one task compares as they are.
BLOCK = 1024
BLOCK_SHINGLES = 2_000_000
#: Bits of a parity fingerprint, and of that of sets of more than LONG elements.
SKETCH, SKETCH_LONG, LONG = 1024, 4096, 1500
#: The most sets of a key whose fingerprints are compared.
DIRECT = 2048
#: Sets of a component that all its blocks have.
SHARED = 8


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 values of word shingles, sorted; a text of fewer words is one shingle, none is empty."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    values = np.sort(np.array([digest(joined[x:y], SEED) for x, y in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], np.uint64))
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def leading(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The elements of which two sets with a similarity of 4/5 share one: the rarest by order, ties by value."""
    n = len(values)
    if not n:
        return values
    rank = order[(values % np.uint64(len(order))).astype(np.int64)]
    return values[np.lexsort((values, rank))][: n - (4 * n + 4) // 5 + 1]


def parities(values: np.ndarray) -> bytes:
    """Of each class of elements (their lowest bits), whether their number is odd."""
    bits = SKETCH_LONG if len(values) > LONG else SKETCH
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _tally(bins: int):
    """A part's counts: rows (chunk, at, n) of nonzero counters, as uint16 within a chunk and uint16, at most 65,535."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(bins, np.uint32), [], 0

        def add() -> None:
            at, n = np.unique(np.concatenate(waiting), return_counts=True)
            total[at] += n.astype(np.uint32)
            waiting.clear()

        for batch in batches:
            for text in batch.column(0):
                waiting.append((shingles(text.as_py()) % np.uint64(bins)).astype(np.uint32))
                held += len(waiting[-1])
                if held > 1 << 18:
                    add()
                    held = 0
        if waiting:
            add()
        rows = []
        for k, part in enumerate(total.reshape(-1, min(CHUNK, bins))):
            at = np.flatnonzero(part)
            if len(at):
                rows.append((k, at.astype("<u2").tobytes(), np.minimum(part[at], 65535).astype("<u2").tobytes()))
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 64]), (pa.int32(), pa.binary(), pa.binary()))], ["chunk", "at", "n"])

    return run


def _added(bins: int):
    size = min(CHUNK, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                total.setdefault(k, np.zeros(size, np.int64))[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u2")
        levels = [np.minimum(16 * np.log2(x + 1), 255).astype(np.uint8).tobytes() for x in total.values()]  # 16 steps for each doubling
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(levels, pa.binary())], ["chunk", "levels"])

    return run


def common_order(rows: DataFrame, bins: int) -> np.ndarray:
    """For each counter of shingles, its place from rare (0) to frequent (255), over all texts of rows."""
    parts = rows.select("text").mapInArrow(frugal(_tally(bins)), "chunk int, at binary, n binary")
    parts = materialise(parts, "tally")
    added = parts.repartition(partitions(rows.sparkSession), "chunk").mapInArrow(frugal(_added(bins)), "chunk int, levels binary")
    out = np.zeros(bins, np.uint8)
    for r in added.collect():  # bins bytes in all
        out[r["chunk"] * min(CHUNK, bins) :][: min(CHUNK, bins)] = np.frombuffer(r["levels"], np.uint8)
    return out


PRINTS = "doc_id long, file string, row long, fp long, sim long, size int, sketch binary, keys array<long>"


def _prints(order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in (b.slice(i, 1000) for b in batches for i in range(0, len(b), 1000)):
            fp, sim, size, sketch, keys, cuts = [], [], [], [], [np.zeros(0, np.uint64)], [0]
            for text in batch.column(1):
                values = shingles(text.as_py())
                fp.append(xxhash.xxh64_intdigest(values.tobytes(), SEED))
                sim.append(majority((values[i : i + 65536] for i in range(0, len(values), 65536)), len(values)))
                size.append(len(values))
                sketch.append(parities(values))
                keys.append(leading(values, order.value))
                cuts.append(cuts[-1] + len(keys[-1]))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
            made = [*(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, sim)), pa.array(size, pa.int32()), pa.array(sketch, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *made], [x.split()[0] for x in PRINTS.split(", ")])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, size, fp: distinct ones with a neighbour under their key that fits, and a part's first and last keys.

    size holds a set's size in its upper half, the key's place among the set's elements in its lower.
    """
    kept, whole = [np.zeros(0, np.int64)] * 3, None  # whole: a key of which every row is kept

    def chosen(columns: list[np.ndarray]) -> list[np.ndarray]:
        key, packed, fp = columns
        size, at = packed >> 32, packed & 0xFFFFFFFF
        near = (key[:-1] == key[1:]) & (5 * size[:-1] >= 4 * size[1:])
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        two = starts[np.diff(np.append(starts, len(key))) == 2]
        near[two] &= 9 * np.minimum(size[two] - at[two], size[two + 1] - at[two + 1]) >= 4 * (size[two] + size[two + 1])
        keep = key == whole
        keep[:-1] |= near
        keep[1:] |= near
        return [c[keep] for c in columns]

    for batch in batches:
        columns = [np.concatenate([old, np.asarray(batch.column(i)).astype(np.int64)]) for i, old in enumerate(kept)]
        key, _, fp = columns
        if not len(key):
            continue
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])])
        columns = [c[new] for c in columns]
        whole = columns[0][0] if whole is None else whole
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if not cut and len(columns[0]) > 100_000:
            cut, whole = len(columns[0]) - 1, columns[0][0]
        if cut:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in chosen([c[:cut] for c in columns])], ["key", "size", "fp"])
        kept = [c[cut:] for c in columns]
    if len(kept[0]):  # the last key may go on in the next part
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in kept], ["key", "size", "fp"])


def allowed(a: slice | np.ndarray, b: int | np.ndarray, size: np.ndarray, at: np.ndarray, sketch: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Which of the pairs of positions may be alike, by sizes, places of the key, and fingerprints."""
    both = size[a] + size[b]
    ok = (9 * np.abs(size[a] - size[b]) <= both) & (9 * np.minimum(size[a] - at[a], size[b] - at[b]) >= 4 * both)
    for words, wide in ((slice(0, SKETCH // 64), False), (slice(SKETCH // 64, None), True)):
        x = np.flatnonzero(ok & full[a] & full[b]) if wide else np.flatnonzero(ok)
        ok[x] = 9 * np.bitwise_count(sketch[a[x], words] ^ sketch[b[x] if isinstance(b, np.ndarray) else b, words]).sum(1, dtype=np.int64) <= both[x]
    return ok


def forest(fp: np.ndarray, size: np.ndarray, at: np.ndarray, sketch: np.ndarray, full: np.ndarray) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the pairs that allowed lets pass.

    It grows from the least fp, so that keys with much the same sets give the same edges.
    """
    edges, left = [], np.argsort(fp)
    while len(left):
        found, left = [int(left[0])], left[1:]
        for one in found:
            if not len(left):
                break
            near = allowed(left, one, size, at, sketch, full)
            if near.any():
                new = left[near].tolist()
                edges += [(one, x) for x in new]
                found += new
                left = left[~near]
    return edges


def folded(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of SKETCH bits, then SKETCH_LONG bits; and which ones have the latter."""
    short, long_ = SKETCH // 8, SKETCH_LONG // 8
    full = np.array([len(x) == long_ for x in sketches], bool)
    out = np.zeros((len(sketches), (short + long_) // 8), np.uint64)
    if full.any():
        wide = np.frombuffer(b"".join(x for x in sketches if len(x) == long_), np.uint64).reshape(-1, long_ // 8)
        out[full, short // 8 :] = wide
        out[full, : short // 8] = np.bitwise_xor.reduce(wide.reshape(len(wide), -1, short // 8), axis=1)
    if not full.all():
        out[~full, : short // 8] = np.frombuffer(b"".join(x for x in sketches if len(x) != long_), np.uint64).reshape(-1, short // 8)
    return out, full


def by_simhash(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """fp, near of each class: near is the least fp of the component that links of SimHash fingerprints (sim) put it in."""
    total = classes.count()
    sims = materialise(classes.groupBy("sim").agg(F.min("fp").alias("least"), F.count("*").alias("n")), "simhashes")
    found = components(links(spark, sims.select(F.col("sim").alias("fp")), sims.count(), DISTANCE))
    sims = materialise(sims.join(found, sims["sim"] == found["v"], "left").select("sim", "least", "n", F.coalesce("label", "sim").alias("label")), "simhashes")
    groups = sims.groupBy("label").agg(F.min("least").alias("near"), F.count("*").alias("members"))
    named = join_by_key(sims.select("sim", "n", "label"), groups, "label", "members", total).select("sim", "n", "near")
    return materialise(join_by_key(classes.select("sim", "fp"), named, "sim", "n", total).select("fp", "near"), "simhash-links")


CHAINED = "a long, b long, part int, key long, size long"


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from rows sorted by key, size, fp, and the part's first and last row: fp as a, 0 or 1 as b, with part, key and size."""

    def made(a, b, ends=None) -> pa.RecordBatch:
        ends = ends or [[None] * len(a)] * 3
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(ends[0], pa.int32()), pa.array(ends[1], pa.int64()), pa.array(ends[2], pa.int64())], [x.split()[0] for x in CHAINED.split(", ")])

    def chain(key, packed, fp, near) -> pa.RecordBatch:
        """Neighbours: sets of fitting sizes are joined by those between them."""
        size = packed >> 32
        at = np.flatnonzero((key[:-1] == key[1:]) & (near[:-1] != near[1:]) & (5 * size[:-1] >= 4 * size[1:]))
        return made(fp[at], fp[at + 1])

    def compared(key, packed, fp, near, sketch, full) -> pa.RecordBatch:
        """Edges of rows of whole keys; sets that SimHash has linked need none."""
        size, place = packed >> 32, packed & 0xFFFFFFFF
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        mixed = np.minimum.reduceat(near, starts) != np.maximum.reduceat(near, starts)
        starts, ends = starts[mixed], ends[mixed]
        two = starts[ends - starts == 2]
        two = two[allowed(two, two + 1, size, place, sketch, full)]
        a, b = [fp[two]], [fp[two + 1]]
        for x, y in zip(starts.tolist(), ends.tolist()):
            if y - x > 2:
                if y - x > DIRECT:
                    edges = chain(key[x:y], packed[x:y], fp[x:y], near[x:y])
                    a.append(np.asarray(edges.column(0)))
                    b.append(np.asarray(edges.column(1)))
                elif found := forest(fp[x:y], size[x:y], place[x:y], sketch[x:y], full[x:y]):
                    at = np.array(found) + x
                    a.append(fp[at[:, 0]])
                    b.append(fp[at[:, 1]])
        a, b = np.concatenate(a), np.concatenate(b)
        return made(a[a != b], b[a != b])

    part, chained, last = TaskContext.get().partitionId(), None, None  # chained: a key that goes beyond these rows
    held = [np.zeros(0, np.int64)] * 4 + [np.zeros((0, (SKETCH + SKETCH_LONG) // 64), np.uint64), np.zeros(0, bool)]
    for batch in batches:
        if not len(batch):
            continue
        new = [np.asarray(batch.column(i)).astype(np.int64) for i in range(4)] + [*folded(batch.column(4).to_pylist())]
        if chained is None:
            chained = new[0][0]
            yield made(new[2][:1], [0], [[part], new[0][:1], new[1][:1]])
        held = [np.concatenate([x, y]) for x, y in zip(held, new)]
        cut = int(np.searchsorted(held[0], held[0][-1]))  # the last key may go on
        done = [x[:cut] for x in held]
        if cut:
            own = int(np.searchsorted(done[0], chained, "right"))
            yield chain(*(x[:own] for x in done[:4]))
            if own < cut:
                yield compared(*(x[own:] for x in done))
            held = [x[cut:] for x in held]
        if len(held[0]) > 20 * DIRECT:  # a very frequent key is chained as it comes
            yield chain(*held[:4])
            held, chained = [x[-1:] for x in held], held[0][0]
        last = [x[-1:] for x in held]
    if last is not None:
        yield chain(*held[:4])
        yield made(last[2], [1], [[part], last[0], last[1]])


def candidates(spark: SparkSession, prints: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) of a graph in which all sets that share a leading element and may be alike are connected.

    prints has the leading elements of each set in order (keys), classes one row a set (fp). Where
    classes has near, sets of equal near are connected already and are not connected again.
    """
    near = "near" if "near" in classes.columns else F.col("fp").alias("near")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartitionByRange(partitions(spark), "key", "size", "fp").sortWithinPartitions("key", "size", "fp")

    keyed = prints.select(F.posexplode("keys").alias("at", "key"), (F.shiftleft(F.col("size").cast("long"), 32) + F.col("at")).alias("size"), "fp").drop("at")
    shared = materialise(dealt(keyed).mapInArrow(frugal(_shared), "key long, size long, fp long"), "shared")
    with_sketch = materialise(shared.join(classes.select("fp", near, "sketch"), "fp").select("key", "size", "fp", "near", "sketch"), "sketches")
    found = materialise(dealt(with_sketch).mapInArrow(frugal(_paired), CHAINED), "candidates")
    ends = sorted((r["part"], r["b"], r["key"], r["size"], r["a"]) for r in found.filter("part is not null").collect())  # two a part
    over = [(x[4], y[4]) for x, y in zip(ends[1::2], ends[2::2]) if x[2] == y[2] and x[4] != y[4] and 5 * (x[3] >> 32) >= 4 * (y[3] >> 32)]
    return found.filter("part is null").select("a", "b").union(spark.createDataFrame(over, "a long, b long"))


def linked(sets: list[np.ndarray], order: np.ndarray) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the pairs with a similarity of at least 4/5."""
    leads = [leading(s, order) for s in sets]
    keys = np.concatenate(leads)
    sort = np.argsort(keys, kind="stable")
    keys, owner = keys[sort], np.repeat(np.arange(len(sets)), [len(x) for x in leads])[sort]
    size = np.array([len(s) for s in sets])
    left = np.ones(len(sets), bool)
    edges = []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root], found = False, [root]
        for at in found:
            a, b = np.searchsorted(keys, leads[at]), np.searchsorted(keys, leads[at], "right")
            near = np.zeros(len(sets), bool)
            for x, y in zip(a.tolist(), b.tolist()):
                near[owner[x:y]] = True
            near &= left & (5 * size >= 4 * size[at]) & (5 * size[at] >= 4 * size)
            for x in np.flatnonzero(near).tolist():
                place = np.minimum(np.searchsorted(sets[at], sets[x]), size[at] - 1)
                both = int((sets[at][place] == sets[x]).sum())
                if 5 * both >= 4 * (int(size[at]) + int(size[x]) - both):
                    left[x] = False
                    found.append(x)
                    edges.append((at, x))
    return edges


def _verified(order):
    def edges(fp: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        found = linked(sets, order.value)
        return pa.RecordBatch.from_arrays([pa.array([fp[a] for a, _ in found], pa.int64()), pa.array([fp[b] for _, b in found], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, fp, sets = None, [], []
        for batch in batches:  # sorted by label, part
            for at, part, print_, text in zip(*batch.columns):
                at, print_ = (at.as_py(), part.as_py()), print_.as_py()
                if at != label and sets:
                    yield edges(fp, sets)
                    fp, sets = [], []
                label = at
                fp.append(print_)
                sets.append(shingles(text.as_py()))
        if sets:
            yield edges(fp, sets)

    return run


def compared(spark: SparkSession, rows: DataFrame, groups: DataFrame, order) -> DataFrame:
    """Edges (a, b): exact links within each group (label, part) of sets fp, whose texts stand at file and row."""
    texts = sieve(rows.select("file", "row", "text"), groups, "file", "row").join(groups, ["file", "row"]).select("label", "part", "fp", "text")
    dealt = texts.repartition(partitions(spark), "label", "part").sortWithinPartitions("label", "part")
    return materialise(dealt.mapInArrow(frugal(_verified(order)), "a long, b long"), "near-links")


def _large(spark: SparkSession, rows: DataFrame, members: DataFrame, order) -> DataFrame:
    """Links within components that one task can't compare; members has the number of blocks too."""

    block = F.pmod(F.xxhash64("fp"), "blocks").cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    picks = members.groupBy("label").agg(F.array_distinct(F.array(*[F.min_by("fp", F.xxhash64("fp", F.lit(i))) for i in range(SHARED)])).alias("fps"))
    shared = members.join(picks.select("label", F.explode("fps").alias("fp")), ["label", "fp"]).select(*members.columns)
    shared = shared.withColumn("part", F.explode(every)).filter(F.col("part") != block)
    edges = compared(spark, rows, members.withColumn("part", block).unionByName(shared), order)
    found = components(edges).select(F.col("v").alias("fp"), F.col("label").alias("found"))
    parts = materialise(members.join(found, "fp", "left").withColumn("found", F.coalesce("found", "fp")), "near-parts")
    sizes = parts.groupBy("label", "found").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    most = sizes.groupBy("label").agg(F.max(F.struct("n", "found", "held")).alias("m"), F.sum("n").alias("all"), F.sum("held").alias("held"))
    fits = (F.col("all") - F.col("m.n") <= BLOCK) & (F.col("held") - F.col("m.held") <= BLOCK_SHINGLES)
    most = most.filter(F.col("all") > F.col("m.n")).select("label", "all", F.col("m.found").alias("main"), fits.alias("few"))
    open_ = join_by_key(parts, most, "label", "all", parts.count())
    # the main part is one piece already: its blocks meet the other sets; if those are many, blocks meet in pairs
    few = open_.filter("few").withColumn("part", F.explode(F.when(F.col("found") == F.col("main"), F.array(block)).otherwise(every)))
    pair = F.least(block, F.col("with")) * F.col("blocks") + F.greatest(block, F.col("with"))
    rest = open_.filter("not few").withColumn("with", F.explode(every)).withColumn("part", pair.cast("int")).drop("with")
    return edges.union(compared(spark, rows, few.unionByName(rest), order))


def near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (of its set of shingles), component_id, stays, and its file and row.

    Links are pairs with a Jaccard similarity of at least 4/5, found by SimHash or, where its
    fingerprints differ in more than DISTANCE bits, by leading elements; texts without words are equal.
    One row of each component stays, chosen as by simhash.near_duplicates.
    """
    docs = in_files(docs)
    rows = located(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", "file", "row")
    order = spark.sparkContext.broadcast(common_order(rows, BINS))
    prints = materialise(rows.mapInArrow(frugal(_prints(order)), PRINTS), "shingles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "row")).alias("first")
    classes = materialise(prints.groupBy("fp").agg(first, F.count("*").alias("n"), F.first("sim").alias("sim"), F.first("size").alias("size"), F.first("sketch").alias("sketch")), "classes")
    near = by_simhash(spark, classes)
    more = candidates(spark, prints, classes.select("fp", "sketch").join(near, "fp"))
    maybe = components(near.filter("fp <> near").select(F.col("fp").alias("a"), F.col("near").alias("b")).union(more))
    sums = maybe.join(classes.select("fp", "size"), maybe["v"] == F.col("fp")).groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("all"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("all") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    named = join_by_key(maybe, sums.select("label", "n", blocks), "label", "n", classes.count()).select("label", "v", "blocks")
    # one row of each class has its set's text
    members = named.join(classes, named["v"] == classes["fp"]).select("label", "blocks", "fp", "size", F.col("first.file").alias("file"), F.col("first.row").alias("row"))
    members = materialise(members, "candidates")
    edges = compared(spark, rows, members.filter("blocks = 1").withColumn("part", F.lit(0)), order)
    large = members.filter("blocks > 1")
    if not large.isEmpty():
        edges = edges.union(_large(spark, rows, large, order))
    return kept_rows(prints, classes.drop("sim", "size", "sketch"), components(edges))
