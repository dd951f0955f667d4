"""Quality classifier by co-training.

Two classifiers see separate views of a document: one its text (hashed words and byte trigrams,
pairs of byte classes, word statistics), the other its metadata (source, language tag, recorded
length). Both start from a bounded sample of labelled rows. In each round, all other rows are
judged by both as they pass; where one is confident, by calibrated probability, its label is a
lesson for the other: sums of gradients and curvatures over all such rows, which move the
other's weights by one step. In the end a calibrated combination of both views, fitted on
labelled rows that neither was trained on, scores all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.token_ids import batch_parts
from lodestack.llm.work import frugal

RESULT = "doc_id long, quality double, text_score double, meta_score double, kept boolean"
#: Byte classes: control, space, newline, lower case, upper case, digit, ".,;:", quotes and brackets, beyond ASCII, and single marks.
MARKS = b"!|#$%&*"
KINDS = 9 + len(MARKS)


def _kinds() -> np.ndarray:
    out = np.full(256, 7, np.uint8)
    for kind, members in enumerate((range(32), b" \t", b"\n\r", range(97, 123), range(65, 91), range(48, 58), b".,;:")):
        out[list(members)] = kind
    out[128:] = 8
    out[list(MARKS)] = np.arange(9, KINDS)
    return out


KIND = _kinds()
#: Buckets of hashed words and of hashed byte trigrams.
WORDS, GRAMS = 128, 128
SHAPES = KINDS * KINDS + KINDS + 6
TEXT_SIZE = SHAPES + WORDS + GRAMS
SOURCES, LANGS, LENGTHS = 64, 16, 24
META_SIZE = SOURCES + LANGS + LENGTHS + 3


def text_view(text: str | None) -> np.ndarray:
    """Of the whole text: shares (square roots) of byte-class pairs, word statistics, shares of hashed words and byte trigrams."""
    out = np.zeros(TEXT_SIZE, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        out[SHAPES - 1] = 1
        return out
    data = np.frombuffer(raw, np.uint8)
    k = KIND[data]
    if len(k) > 1:
        out[: KINDS * KINDS] = np.sqrt(np.bincount(k[:-1] * np.uint16(KINDS) + k[1:], minlength=KINDS * KINDS) / (len(k) - 1))
    out[KINDS * KINDS : SHAPES - 6] = np.sqrt(np.bincount(k, minlength=KINDS) / len(k))
    words = raw.split()
    if n := len(words):
        again = sum(map(bytes.__eq__, words, words[1:]))
        out[SHAPES - 6 : SHAPES - 1] = (len(set(words)) / n, again / n, min(1.0, len(raw) / n / 20), np.log1p(n) / 12, len(set(raw.split(b"\n"))) / (raw.count(b"\n") + 1))
        out[SHAPES : SHAPES + WORDS] = np.sqrt(np.bincount(np.fromiter(map(zlib.crc32, words), np.uint32, n) % WORDS, minlength=WORDS) / n)
    if len(data) > 2:
        grams = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(25)
        out[SHAPES + WORDS :] = np.sqrt(np.bincount(grams, minlength=GRAMS) / len(grams))
    return out


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    for value, size, base in ((source, SOURCES, 0), (lang, LANGS, SOURCES)):
        if value is not None:
            out[base + zlib.crc32(str(value).encode("utf-8", "surrogatepass")) % size] = 1
    length = max(0, n_chars or 0)
    out[SOURCES + LANGS + min(LENGTHS - 1, int(np.log2(length + 1)))] = 1
    out[-3:] = source is None, lang is None, n_chars is None
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights, the last for the constant, by Newton's method on the penalised likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    weight = np.ones(len(x)) if weight is None else weight
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grade = x.T @ (weight * (p - y)) + keep * w
        move = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), grade)
        w -= move * min(1.0, 5 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-5:
            break
    return w


def margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    """Per view: classifier and calibration; and the combination of both calibrated margins."""

    views: list[np.ndarray] = field(default_factory=list)
    scales: list[np.ndarray] = field(default_factory=list)
    joint: np.ndarray | None = None

    def scores(self, *x: np.ndarray) -> tuple[np.ndarray, ...]:
        z = [margin(c, margin(w, v)[:, None]) for w, c, v in zip(self.views, self.scales, x)]
        return (sigmoid(margin(self.joint, np.stack(z, 1))), *map(sigmoid, z))


class Lessons:
    """What each view learns from rows of whose label the other is sure: sums that add up over parts of the rows.

    Per view: number of rows, gradient and diagonal of the curvature of the logistic loss.
    """

    def __init__(self, sizes: tuple[int, int]):
        self.sums = [np.zeros(1 + 2 * (size + 1)) for size in sizes]

    def add(self, model: Model, views: tuple[np.ndarray, ...], sure: float) -> None:
        z = [margin(w, x) for w, x in zip(model.views, views)]
        p = [sigmoid(margin(c, m[:, None])) for c, m in zip(model.scales, z)]
        for v, x in enumerate(views):
            other = p[1 - v]
            at = np.flatnonzero(np.maximum(other, 1 - other) >= sure)
            if not len(at):
                continue
            x = np.hstack([x[at], np.ones((len(at), 1))]).astype(np.float64)
            own, n = sigmoid(z[v][at]), x.shape[1]
            self.sums[v][0] += len(at)
            self.sums[v][1 : 1 + n] += x.T @ (own - (other[at] > 0.5))
            self.sums[v][1 + n :] += (x * x).T @ (own * (1 - own))


def taught(w: np.ndarray, x: np.ndarray, y: np.ndarray, lesson: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights after one step on labelled rows and a lesson. Together its rows weigh as much as the labelled ones, at most half each."""
    n, grade, curve = lesson[0], lesson[1 : 1 + len(w)], lesson[1 + len(w) :]
    if not n:
        return w
    weight = min(0.5, len(y) / n)
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    p = sigmoid(x @ w)
    own = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x
    move = np.linalg.solve(own * (1 + weight * n / len(y)) + np.diag(keep + weight * curve), x.T @ (p - y) + weight * grade + keep * w)
    return w - move * min(1.0, 5 / (np.abs(move).max() + 1e-12))


def co_train(labelled: tuple[np.ndarray, ...], y: np.ndarray, pool: tuple[np.ndarray, ...] | Callable[[Model, float], Lessons], rounds: int = 2, sure: float = 0.97) -> Model:
    """Co-training over two views. Every fourth labelled row is kept for calibration.

    pool: the other rows' views, or what gives their lessons for a model and a least
    probability. A view that knows nothing is never sure, so it gives no lessons.
    """
    apart = np.arange(len(y)) % 4 == 3
    if len(set(y[~apart])) < 2 or len(set(y[apart])) < 2:
        apart[:] = False
    check = apart if apart.any() else ~apart

    def here(model: Model, sure: float) -> Lessons:
        out = Lessons(tuple(x.shape[1] for x in labelled))
        out.add(model, pool, sure)
        return out

    model = Model([logistic(x[~apart], y[~apart]) for x in labelled])
    for r in range(rounds + 1):
        model.scales = [logistic(margin(w, x[check])[:, None], y[check], ridge=1e-2) for w, x in zip(model.views, labelled)]
        if r < rounds:
            lessons = (pool if callable(pool) else here)(model, sure)
            model.views = [taught(w, x[~apart], y[~apart], lesson) for w, x, lesson in zip(model.views, labelled, lessons.sums)]
    z = np.stack([margin(c, margin(w, x[check])[:, None]) for w, c, x in zip(model.views, model.scales, labelled)], 1)
    model.joint = logistic(z, y[check], ridge=1e-1)
    return model


def _views(batch: pa.RecordBatch, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    text, source, lang, n_chars = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
    a = np.stack([text_view(t) for t in text]) if text else np.zeros((0, TEXT_SIZE), np.float32)
    b = np.stack([meta_view(*m) for m in zip(source, lang, n_chars)]) if text else np.zeros((0, META_SIZE), np.float32)
    return a, b


COLUMNS = ("text", "source", "lang", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


#: Parts that sums of lessons pass through on the way to the driver.
PARTS = 64


def lessons_of(spark: SparkSession, rows: DataFrame, model: Model, sure: float) -> Lessons:
    """Lessons from all rows, one pass; the driver gets PARTS sums."""
    given = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Lessons((TEXT_SIZE, META_SIZE))
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            if batch.num_rows:
                out.add(given.value, _views(batch, COLUMNS), sure)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % PARTS], pa.int32()), pa.array([np.concatenate(out.sums).tobytes()], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for x in batch.column(1):
                total = total + np.frombuffer(x.as_py())
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = rows.mapInArrow(frugal(judge), "part int, sums binary").repartition(PARTS, "part").mapInArrow(add, "sums binary")
    out = Lessons((TEXT_SIZE, META_SIZE))
    for r in sums.collect():
        both = np.frombuffer(r["sums"])
        for total, x in zip(out.sums, np.split(both, [len(out.sums[0])])):
            total += x
    return out


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most_labelled: int = 3000, rounds: int = 2, sure: float = 0.97) -> Model | None:
    """Fit on at most most_labelled labelled ids, the first by a hash, and on all rows of other ids.

    None if the labelled rows don't show both labels. Rows whose doc_id or label is null aren't
    learned from as labelled; where labels repeat for a doc_id, the greatest counts; where rows
    do, one of them.
    """
    known = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    rows = _rows(docs)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            both = np.hstack(_views(batch, COLUMNS)).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in both], pa.binary())], ["doc_id", "x"])

    there = known.join(rows.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled).collect()
    if len({r["label"] > 0 for r in chosen}) < 2:
        return None
    chosen = spark.createDataFrame(chosen, "doc_id long, label int")  # at most most_labelled rows
    made = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").mapInArrow(features, "doc_id long, x binary").groupBy("doc_id").agg(F.min("x").alias("x"))
    got = sorted(made.join(F.broadcast(chosen), "doc_id").collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    y = np.array([float(r["label"] > 0) for r in got])
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), "<f4").reshape(-1, TEXT_SIZE + META_SIZE)
    others = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    return co_train((x[:, :TEXT_SIZE], x[:, TEXT_SIZE:]), y, lambda model, sure: lessons_of(spark, others, model, sure), rounds, sure)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds: int) -> DataFrame:
    """Per document: doc_id, quality (probability), text_score, meta_score, kept.

    Whole texts are read. Null text and null metadata are values of their own; repeated rows are
    scored each; an empty table gives no rows; other columns are ignored. Without labels of both
    kinds nothing can be judged: all scores are null and every document is kept.
    """
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            if model.value is None:
                none = pa.nulls(batch.num_rows, pa.float64())
                scores = [none, none, none, pa.array([True] * batch.num_rows, pa.bool_())]
            else:
                s = model.value.scores(*_views(batch, COLUMNS))
                scores = [*(pa.array(x.astype(np.float64)) for x in s), pa.array(s[0] >= threshold)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *scores], ["doc_id", "quality", "text_score", "meta_score", "kept"])

    return _rows(docs).mapInArrow(run, RESULT)


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds: int) -> DataFrame:
    """The rows of docs, with all their columns, that score keeps. No join: rows are judged as they pass."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            if model.value is not None and batch.num_rows:
                batch = batch.filter(pa.array(model.value.scores(*_views(batch, COLUMNS))[0] >= threshold))
            yield batch

    return docs.mapInArrow(frugal(run), docs.schema)
