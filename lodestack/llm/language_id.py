"""Language identification by prediction by partial matching.

For each language a context tree over bytes holds, for contexts of up to `order` bytes, how
often each byte followed. The probability of a byte is that of the longest context that has
seen it; each longer context that has not is paid for by an escape (method C: a context with n
followers of d kinds escapes with d / (n + d)); below order 0 all bytes are equal. Statistics are
frozen after training, so the code length of a text under a language is an exact sum.

All trees are compiled into one automaton over bytes: its states are the contexts of the union
of the trees, and each transition carries one cost a language, already summed over escapes. A
state is fixed by the last `order` bytes, so long inputs are scored in lanes that start a few
bytes early, and nothing but the automaton and one batch is in memory.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.token_ids import batch_parts
from lodestack.llm.work import frugal

UND = "und"
LETTER = re.compile(r"[^\W\d_]")
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"
#: Bytes scored at once, and bytes a lane.
WINDOW, LANE = 1 << 20, 256
#: Bytes of a text that are judged together.
SEGMENT = 128


@dataclass
class Model:
    languages: list[str]
    order: int
    classes: np.ndarray  # byte -> class; class 0 ends a document
    step: np.ndarray  # state * classes + class -> state
    cost: np.ndarray  # state * classes + class -> bits for each language

    def code_lengths(self, texts: list[bytes], segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment of each text: bits under each language, the text's number, bytes.

        Segments follow one another within a text; the context runs on across them, so a text's
        code length is the sum of its segments'.
        """
        size = np.array([len(t) for t in texts])
        parts = np.maximum(1, -(-size // segment))
        text = np.repeat(np.arange(len(texts)), parts)
        k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        begins = np.cumsum(size + 1) - size - 1
        starts = begins[text] + k * segment
        end = int(size.sum()) + len(texts)
        data = np.concatenate([np.zeros(self.order + 1, np.uint8), self.classes[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]])
        origin = self.order + 1
        data[origin + begins + size] = 0  # after each text, whatever class that byte has
        total = np.zeros((len(text), len(self.languages)))
        width = int(self.classes.max()) + 1
        for low in range(0, end, WINDOW):
            n = min(WINDOW, end - low)
            lanes = -(-n // LANE)
            at = origin + low + np.arange(lanes) * LANE
            state = np.zeros(lanes, np.int32)
            index = np.zeros((LANE, lanes), np.int32)
            for i in range(-self.order, LANE):
                here = state * width + data[np.minimum(at + i, len(data) - 1)]
                if i >= 0:
                    index[i] = here
                state = self.step[here]
            costs = self.cost[index.T.reshape(-1)[:n]]
            first = int(np.searchsorted(starts, low, "right")) - 1
            last = int(np.searchsorted(starts, low + n, "left"))
            total[first:last] += np.add.reduceat(costs, np.maximum(starts[first:last] - low, 0), axis=0, dtype=np.float64)
        return total, text, np.minimum(segment, size[text] - k * segment)


def train(samples: dict[str, list[bytes]], order: int = 4, states: int = 6000) -> Model:
    """Context trees of every language in one automaton.

    samples gives texts by language. The contexts kept are the `states` most frequent over all
    languages together; a context is never kept without its shorter ones, so the trees are of
    variable order.
    """
    languages = sorted(samples)
    counts: list[list[Counter]] = []  # language, length - 1 -> gram -> number
    for name in languages:
        grams: list[Counter] = [Counter() for _ in range(order + 1)]
        for text in samples[name]:
            for k in range(1, order + 2):
                grams[k - 1].update(text[i : i + k] for i in range(len(text) - k + 1))
        counts.append(grams)
    seen: Counter = Counter()
    for grams in counts:
        for k in range(order):
            seen.update(grams[k])
    ranked = sorted(seen.items(), key=lambda p: (-p[1], len(p[0]), p[0]))[: states - 1]
    kept = {c for c, _ in ranked}
    kept = {c for c in sorted(kept, key=len) if len(c) == 1 or (c[1:] in kept and c[:-1] in kept)}
    contexts = [b"", *sorted(kept, key=lambda c: (len(c), c))]
    place = {c: i for i, c in enumerate(contexts)}
    used = sorted({g[0] for grams in counts for g in grams[0]})
    rare = len(used) < 255
    classes = np.full(256, len(used) + 1 if rare else 1, np.uint8)
    classes[used] = np.arange(1, len(used) + 1)
    width = int(classes.max()) + 1
    step = np.zeros((len(contexts), width), np.int32)
    cost = np.zeros((len(contexts), width, len(languages)), np.float32)
    for i, c in enumerate(contexts):
        for b in used:
            longer = c + bytes([b])
            while longer not in place:
                longer = longer[1:]
            step[i, classes[b]] = place[longer]
    for x, grams in enumerate(counts):
        follow: dict[bytes, dict[int, int]] = {c: {} for c in contexts}
        for k in range(order + 1):
            for g, n in grams[k].items():
                if (f := follow.get(g[:-1])) is not None:
                    f[g[-1]] = n
        for i, c in enumerate(contexts):  # shorter contexts come first
            below = cost[place[c[1:]], :, x] if c else np.full(width, 8.0, np.float32)
            f = follow[c]
            n, d = sum(f.values()), len(f)
            row = below.copy() if not n else below + np.float32(np.log2((n + d) / d))
            for b, m in f.items():
                row[classes[b]] = np.log2((n + d) / m)
            row[0] = 0
            cost[i, :, x] = row
    return Model(languages, order, classes, step.reshape(-1), cost.reshape(-1, len(languages)))


#: Most values of lang that are learned.
LANGUAGES = 200


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, texts: int, longest: int, bytes_each: int) -> dict[str, list[bytes]]:
    """Bounded training sample: per language, whole texts in the order of a hash of the id.

    At most about `texts` distinct rows of at most `longest` characters reach the driver for each
    language, and of those the first that hold `bytes_each` bytes together are learned from. Of the
    values of lang, the LANGUAGES most frequent are languages.
    """
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("lang").cast("string").alias("lang"), "doc_id", "text")
    number = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not number:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in number.items() for x in (k, min(1.0, texts / n))])
    unit = (F.xxhash64("doc_id", "lang", "text") / F.lit(2.0**64)) + 0.5
    small = rows.filter((unit < F.coalesce(share[F.col("lang")], F.lit(0.0))) & (F.length("text") <= longest) & (F.length("text") > 0)).distinct()
    out: dict[str, list[bytes]] = {}
    size: Counter = Counter()
    for r in small.withColumn("unit", unit).orderBy("unit", "doc_id", "text").select("lang", "text").toLocalIterator():
        if size[r["lang"]] < bytes_each and LETTER.search(r["text"]):
            out.setdefault(r["lang"], []).append(r["text"].encode("utf-8", "surrogatepass"))
            size[r["lang"]] += len(out[r["lang"]][-1])
    return out


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float], list[float | None]]:
    """Of each text: language, score, bits a byte."""
    texts = [t or "" for t in texts]
    known = [i for i, t in enumerate(texts) if model and LETTER.search(t)]
    names, scores, bits = [UND] * len(texts), [0.0] * len(texts), [None] * len(texts)
    if known:
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in known]
        length, text, size = model.code_lengths(raw)
        likely = np.exp2(length.min(1, keepdims=True) - length)
        likely *= (size / likely.sum(1))[:, None]
        heads = np.flatnonzero(np.diff(text, prepend=-1))
        share = np.add.reduceat(likely, heads) / np.add.reduceat(size, heads)[:, None]
        least = np.add.reduceat(length, heads).min(1)
        for i, k, s, n, b in zip(known, share.argmax(1).tolist(), share.max(1).tolist(), least.tolist(), raw):
            names[i], scores[i], bits[i] = model.languages[k], min(1.0, s), n / len(b)
    return names, scores, bits


def identify(spark: SparkSession, docs: DataFrame, order: int = 4, states: int = 6000, texts: int = 400, longest: int = 20_000, bytes_each: int = 300_000) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, bits_per_byte.

    Only text decides a prediction. `und`, with score 0, if text is null or has no letter, or
    if nothing could be learned. score is the share of the whole text's bytes that is in the
    predicted language, each segment's posterior at equal priors coming from its exact code
    lengths; so a passage in another language, however badly it codes, counts by its size. Ties
    go to the first language by name. bits_per_byte is the least code length of the whole text.
    Repeated rows are predicted each, an empty table gives no rows, other columns are ignored.
    """
    learned = sample(docs, texts, longest, bytes_each)
    model = spark.sparkContext.broadcast(train(learned, order, states) if learned else None)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            names, scores, bits = predict(model.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, RESULT)


def keep_known(spark: SparkSession, docs: DataFrame, least: float = 0.4, order: int = 4, states: int = 6000, texts: int = 400, longest: int = 20_000, bytes_each: int = 300_000) -> DataFrame:
    """The rows of docs, with all their columns, of a known language.

    A row goes if its language is `und` or its score is below least: most of it is in no one
    language. If nothing could be learned (no row has a language tag), only rows without a letter go.
    """
    learned = sample(docs, texts, longest, bytes_each)
    model = spark.sparkContext.broadcast(train(learned, order, states) if learned else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "text", 2_000_000)):
            found = batch.column(batch.schema.get_field_index("text")).to_pylist()
            if model.value is None:
                keep = [bool(LETTER.search(t or "")) for t in found]
            else:
                names, scores, _ = predict(model.value, found)
                keep = [n != UND and s >= least for n, s in zip(names, scores)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(frugal(run), docs.schema)
