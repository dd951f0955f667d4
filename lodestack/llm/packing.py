"""Best-fit packing of token pieces by a configuration linear program.

Lengths are counted over all pieces; that histogram has at most `capacity` entries however
large the input is, so the program is solved on the driver in bounded memory. A configuration
is a multiset of lengths that fits one sequence. Multiplicative weights on the covering
constraints price configurations, and a knapsack dynamic program finds those of greatest
weight, until all lengths are covered. The fractional solution is rounded to whole sequences,
and solved again for what is left, until they hold at least SOLVED of all tokens; the remainder
goes by best fit into gaps and new sequences, still on counts. Then every piece takes its place
by its rank within its length; no group of pieces is gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestack.llm.token_ids import encoder, text_groups, tokenizer_path
from lodestack.llm.work import frugal, materialise

#: Bytes of texts that are encoded at once; what they need meanwhile is about ten times that.
GROUP = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
RESULT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def knapsack(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: best weight for each room, and the last index taken."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        if k := fits[c]:
            x = best[c - lengths[:k]] + weights[:k]
            i = k - 1 - int(x[::-1].argmax())  # the longest of equals
            best[c], last[c] = x[i], i
    return best, last


def configuration_program(histogram: dict[int, int], capacity: int, rounds: int = 100, eta: float = 4.0, width: float = 3.0, slack: float = 1.002, tolerance: float = 0.01, least: float = 0.99) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Fractional numbers of configurations (descending lengths) that cover the histogram, and how far each length is covered.

    Multiplicative weights for the covering program: rounds portions of equal value add up to
    slack times the least that the tokens need. The price of a length is its share of the
    capacity times exp(eta * lag), lag being how far its coverage is behind the pace, round /
    rounds. A portion consists of the configurations of greatest price, found by knapsacks: from a
    table come, for every length, the heaviest configuration that holds it, and those within
    tolerance of the heaviest of all are taken; no length gets more than width times its share of
    a portion, nor more than its number. So lengths that lack partners gain weight and go first.
    More portions follow, at most as many, while a length is covered less than `least`.
    """
    lengths = np.array(sorted(histogram))
    size = lengths.tolist()
    need = np.array([histogram[x] for x in size], float)
    value = slack * float(need @ lengths) / capacity
    covered, used = np.zeros(len(size)), 0.0
    found: dict[tuple[int, ...], float] = defaultdict(float)
    for r in range(1, 2 * rounds + 1):
        if r > rounds and covered.min() >= least:
            break
        weights = np.where(covered < 1, lengths / capacity * np.exp(np.clip(eta * (r / rounds - covered), -30, 30)), 0.0)
        given = np.minimum(width * need / rounds, np.maximum(0.0, 1 - covered) * need)
        room, price, due = given.tolist(), weights.tolist(), value * r / rounds - used
        while due > 1e-9 * value:
            open_ = np.array(room) > 1e-9
            best, last = knapsack(np.where(open_, weights, 0.0), lengths, capacity)
            bar, before = (1 - tolerance) * best[capacity], due
            heaviest = np.where(open_, weights + best[capacity - lengths], -1.0)
            for i in sorted(np.flatnonzero(heaviest >= bar).tolist(), key=lambda i: (-heaviest[i], -size[i])):
                if room[i] <= 1e-9:
                    continue
                times, c, total = {i: 1}, capacity - size[i], price[i]
                while (j := int(last[c])) >= 0:
                    if room[j] > 1e-9 and price[j] > 0:
                        times[j] = times.get(j, 0) + 1
                        total += price[j]
                    c -= size[j]
                if total < bar:
                    continue
                step = min(due, *(room[j] / n for j, n in times.items()))
                for j, n in times.items():
                    room[j] -= step * n
                due -= step
                found[tuple(sorted((size[j] for j, n in times.items() for _ in range(n)), reverse=True))] += step
                if due <= 1e-9 * value:
                    break
            if due == before:
                break
        used = value * r / rounds - due
        covered += (given - np.array(room)) / need
    return dict(found), covered


def rounded(histogram: dict[int, int], found: dict[tuple[int, ...], float], most: float = float("inf")) -> Counter:
    """Whole numbers of configurations that the histogram holds: each rounded down, then those of few and long pieces rounded up until there are `most`."""
    left, out = Counter(histogram), Counter()
    for up in (False, True):
        for c, x in sorted(found.items(), key=lambda p: (len(p[0]), -sum(p[0]), -(p[1] % 1), p[0])):
            if up and out.total() >= most:
                break
            each = Counter(c)
            k = min([1 if up else int(x + 1e-6), *(left[v] // n for v, n in each.items())])
            if k > 0:
                out[c] += k
                left.subtract({v: n * k for v, n in each.items()})
    return out


def best_fit(left: Counter, placed: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and times, after the pieces left went in descending length into the tightest gaps.

    On counts of like sequences rather than on sequences, so the work doesn't grow with the data.
    """
    bins: dict[int, Counter] = defaultdict(Counter)  # by free room
    for c, k in placed.items():
        bins[capacity - sum(c)][c] += k
    for length in sorted((v for v, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            room = next((r for r in range(length, capacity) if bins.get(r)), None)
            if room is None:
                c, k = (length,) * min(capacity // length, n), 0
                k = n // len(c)
                bins[capacity - length * len(c)][c] += k
                n -= k * len(c)
            else:
                c, have = next(iter(bins[room].items()))
                k = min(n, have)
                bins[room][c] -= k
                if not bins[room][c]:
                    del bins[room][c]
                bins[room - length][(*c, length)] += k
                n -= k
    return [(c, k) for r in sorted(bins) for c, k in sorted(bins[r].items()) if k]


#: Share of all sequences that comes from configurations of the program; the rest goes by best fit.
SOLVED = 0.91


def solved(histogram: dict[int, int], capacity: int) -> Counter:
    """Whole configurations of the program, solved again for what rounding leaves, until they are SOLVED of all sequences."""
    left, out = Counter(histogram), Counter()
    goal = SOLVED * sum(v * n for v, n in histogram.items()) / capacity
    while out.total() < goal:
        found, _ = configuration_program({v: n for v, n in left.items() if n}, capacity)
        new = rounded(left, found, goal - out.total())
        if not new:
            break
        out += new
        for c, k in new.items():
            left.subtract({v: n * k for v, n in Counter(c).items()})
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and times for a histogram of lengths from 1 to capacity."""
    full = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    rest = {v: n for v, n in histogram.items() if v < capacity}
    placed = solved(rest, capacity)
    left = Counter(rest)
    for c, k in placed.items():
        left.subtract({v: n * k for v, n in Counter(c).items()})
    return full + best_fit(left, placed, capacity)


class Slots:
    """For each length: where its pieces go, in runs of like sequences."""

    def __init__(self, configurations: list[tuple[tuple[int, ...], int]], capacity: int):
        runs: dict[int, list] = defaultdict(list)  # length -> (first rank, sequence id of the first, offset)
        seen: Counter = Counter()
        base = 0
        for c, k in configurations:
            offset = 0
            for v in c:
                runs[v].append((seen[v], base, offset))
                seen[v] += k
                offset += v
            base += k
        self.sequences = base
        self.runs = {v: tuple(np.array(x, np.int64) for x in zip(*r)) for v, r in runs.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for v in np.unique(length):
            at = np.flatnonzero(length == v)
            first, base, start = self.runs[int(v)]
            i = np.searchsorted(first, rank[at], "right") - 1
            sequence[at], offset[at] = base[i] + rank[at] - first[i], start[i]
        return sequence, offset


def pieces(docs: DataFrame, capacity: int, tokenizer: str | None, end_id: int) -> DataFrame:
    """One row a piece; place counts the pieces of a length within the part (the task that made it)."""
    model = tokenizer_path(tokenizer)
    names = [x.split()[0] for x in PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in text_groups(texts, GROUP):
                rows = []
                for key, raw in zip(keys[a:b], encoder(model).encode(texts.slice(a, b - a))):
                    raw += tail
                    n = len(raw) // 4
                    first = (n - 1) % capacity + 1  # only the first piece may be shorter
                    start = 0
                    for k in range(-(-n // capacity)):
                        length = capacity if k else first
                        rows.append((key, k, start, length, zlib.crc32(memoryview(raw)[start * 4 : (start + length) * 4]), part, seen[length]))
                        seen[length] += 1
                        start += length
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(frugal(cut, "encoders"), PIECES)


def pack(spark: SparkSession, docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most capacity tokens.

    Null text counts as empty: a piece of one end id. Repeated rows are packed each. An empty
    table gives no rows; other columns are ignored. A text of more than 2 GB, which neither Arrow nor
    Parquet holds as one value, raises when it is read. Per piece: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. The order of pieces within a length is arbitrary.
    """
    made = materialise(pieces(docs, capacity, tokenizer, end_id), "pieces")
    counts = materialise(made.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(Slots(plan(histogram, capacity), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.value.place(np.asarray(batch.column(3)), np.asarray(batch.column(5)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = made.join(base.hint("shuffle_hash"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(put, RESULT)
