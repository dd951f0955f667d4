"""SentencePiece encoding and decoding by a streaming Viterbi search.

Pieces form arcs over the characters. The search keeps, for each boundary in a window bounded by
the longest piece, the arc by which the best path gets there; whenever all paths that survive
run back to one boundary, the ids before it are committed and the window moves on. Which arc is
best depends on the kind of model. Unigram: greatest sum of scores. BPE sums no scores: a
segmentation is what the merges give if and only if they give every two neighbouring pieces of
it by themselves; so each boundary has exactly one such arc, and the ids are the library's.

Whole texts are read in portions. No piece goes on across a space after another character, so
all paths meet before each space: what stands before the last space of a portion is committed,
the rest waits for the next one. Between two such commits the ids of a word come from the search
or, if it was searched before, from a bounded table. A text without spaces for a whole portion
goes on through the search alone, which then commits where its paths meet.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.token_ids import concatenated, distinct_words, text_groups

SPACE = "▁"
UNIGRAM, BPE = 1, 2
#: What an unknown character costs below the least score, as in the library.
UNKNOWN_PENALTY = 10.0
#: Characters of a text that are read at once.
PORTION = 8192


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = raw[at]
        at, out, shift = at + 1, out | (x & 127) << shift, shift + 7
        if x < 128:
            return out, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        if key & 7 == 0:
            value, at = _varint(raw, at)
        else:
            n, at = _varint(raw, at) if key & 7 == 2 else ({5: 4, 1: 8}[key & 7], at)
            value, at = raw[at : at + n], at + n
        yield key >> 3, value


class Codec:
    def __init__(self, model: bytes, kept: int = 400_000):
        from sentencepiece import SentencePieceProcessor

        parts = dict(_fields(model))
        trainer, normalizer = dict(_fields(parts[2])), dict(_fields(parts[3]))
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that keep the text as it is are supported")
        self.kind, self.prefix = trainer.get(3, UNIGRAM), bool(normalizer.get(3, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        library = SentencePieceProcessor(model_proto=model)
        n = library.vocab_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.score = [library.get_score(i) for i in range(n)]
        self.unknown = library.unk_id()
        self.least = min((self.score[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.bytes_at = next((i for i in range(n) if library.is_byte(i)), None)
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on across a space")
        self.trie: dict = {}
        for p, i in self.ids.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.raw = [b"" if library.is_control(i) else bytes([int(self.pieces[i][3:5], 16)]) if library.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.raw[self.unknown] = " ⁇ ".encode()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.kept = kept
        self.commits = self.widest = 0  # commits of stream and of searches in it; the most characters that one waited for

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short text: the pair of greatest score first, the left one of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges leave piece b after piece a (a < 0: at the beginning)."""
        key = a * len(self.pieces) + b
        if (known := self.pairs.get(key)) is None:
            p = self.pieces[b]
            known = self.merged(p) == [p] if a < 0 else self.merged(self.pieces[a] + p) == [self.pieces[a], p]
            if len(self.pairs) < 1_000_000:
                self.pairs[key] = known
        return known

    def segments(self, text: Iterable[str]) -> Iterator[list[tuple[int, str]]]:
        """Committed (id, piece's text) in turn, from characters in any portions.

        Memory: the characters and arcs since the last commit, and longest characters ahead.
        """
        unigram = self.kind == UNIGRAM
        chars, start = "", 0  # chars[0] is at boundary 0 of the window
        back: list = [(-1, -1)]  # by boundary: (where its arc begins, id)
        best = [0.0]
        portions = iter(text)
        ended = False
        while True:
            while not ended and len(chars) - start < 2 * self.longest + 64:
                portion = next(portions, None)
                if portion is None:
                    ended = True
                else:
                    chars += portion
            n = len(chars)
            self.widest = max(self.widest, n)
            back += [None] * (n + 1 - len(back))
            best += [float("-inf")] * (n + 1 - len(best))
            stop = n if ended else n - self.longest
            for i in range(start, stop):
                if back[i] is None:
                    continue
                last = back[i][1]
                node, j = self.trie, i
                single = False
                while j < n and (node := node.get(chars[j])) is not None:
                    j += 1
                    if (piece := node.get("")) is None:
                        continue
                    single = single or j == i + 1
                    if unigram:
                        if best[i] + self.score[piece] > best[j]:
                            best[j], back[j] = best[i] + self.score[piece], (i, piece)
                    elif back[j] is None and (self.fits(last, piece) if last != self.unknown else self.fits(-1, piece)):
                        back[j] = (i, piece)
                if not single and (best[i] + self.least > best[i + 1] if unigram else back[i + 1] is None):
                    best[i + 1], back[i + 1] = best[i] + self.least, (i, self.unknown)
            start = stop
            alive = {k for k in range(start, n + 1) if back[k] is not None} if not ended else {n}
            while len(alive) > 1:  # the farthest goes back until all paths meet
                far = max(alive)
                alive.remove(far)
                alive.add(back[far][0])
            meet = alive.pop()
            path, k = [], meet
            while k > 0:
                i, piece = back[k]
                path.append((piece, chars[i:k]))
                k = i
            if path:
                self.commits += 1
                yield path[::-1]
            if ended:
                return
            if meet > 0:
                chars, start = chars[meet:], start - meet
                back = [(-1, back[meet][1])] + [None if b is None else (b[0] - meet, b[1]) for b in back[meet + 1 :]]
                best = [x - best[meet] for x in best[meet:]]

    def search(self, text: Iterable[str]) -> list[int]:
        out = []
        for part in self.segments(text):
            for piece, chars in part:
                if piece == self.unknown and self.bytes_at is not None:
                    out += [self.bytes_at + b for b in chars.encode("utf-8", "surrogatepass")]
                else:
                    out.append(piece)
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian uint32."""
        if not text:
            return b""
        words, head = text.replace(SPACE, " ").split(" "), b""
        if not self.prefix and (first := words.pop(0)):
            head = self._word(first)
        known = self.words.get
        if "" not in words:
            return head + b"".join([known(w) or self._word(SPACE + w, w) for w in words])
        out, run = [head], 0
        for w in words:
            run += 1
            if w:
                out.append((known(w) if run == 1 else None) or self._word(SPACE * run + w, w if run == 1 else None))
                run = 0
        if run:
            out.append(self._word(SPACE * run))
        return b"".join(out)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """encode of each text; words that single spaces part are made distinct as Arrow arrays first."""
        if not len(texts):
            return []
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE)), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        alone = np.flatnonzero(np.asarray(pc.or_(odd, pc.equal(texts, ""))) if self.prefix else np.ones(len(texts), bool)).tolist()
        bounds, codes, words = distinct_words(texts)
        known = self.words.get
        ids = [(known(w) or self._word(SPACE + w, w)) if w else b"" for w in words]
        out = concatenated(bounds, codes, ids)
        for i in alone:
            out[i] = self.encode(texts[i].as_py())
        return out

    def stream(self, texts: list[Iterable[str]]) -> list[bytes]:
        """Ids of texts, each given as portions of any size, as little-endian uint32."""
        out: list[list[bytes]] = [[] for _ in texts]
        todo = [(i, "", iter(t)) for i, t in enumerate(texts)]  # text, what waits, what comes
        while todo:
            ready, going = [], []
            for i, waits, portions in todo:
                portion = next(portions, None)
                chars = waits + (portion or "")
                self.widest = max(self.widest, len(chars))
                if portion is None:
                    ready.append((i, chars))
                    continue
                cut = chars.replace(SPACE, " ").rstrip(" ").rfind(" ")
                while cut > 0 and chars[cut - 1] in (" ", SPACE):  # before all spaces of a run
                    cut -= 1
                if cut > 0:
                    ready.append((i, chars[:cut]))
                    going.append((i, chars[cut:], portions))
                elif len(chars) <= PORTION:
                    going.append((i, chars, portions))
                else:  # one word: the search alone, to the end
                    head = [] if out[i] or not self.prefix else [SPACE]
                    rest = (x.replace(" ", SPACE) for x in chain(head, [chars], portions))
                    out[i].append(np.array(self.search(rest), "<u4").tobytes())
            # a later part begins with a space, which stands for the mark that a first part is given
            parts = pa.array([x[1:] if self.prefix and out[i] else x for i, x in ready], pa.string())
            self.commits += len(ready)
            for (i, _), ids in zip(ready, self.encode_all(parts)):
                out[i].append(ids)
            todo = going
        return [b"".join(x) for x in out]

    def _word(self, chars: str, key: str | None = None) -> bytes:
        out = np.array(self.search([chars]), "<u4").tobytes()
        if key is not None and len(self.words) < self.kept:
            self.words[key] = out
        return out

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return (raw[1:] if self.prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


def portions(text: str) -> Iterator[str]:
    return (text[i : i + PORTION] for i in range(0, len(text), PORTION))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each Python worker and file."""
    if path not in _CODECS:
        with open(path, "rb") as f:
            _CODECS[path] = Codec(f.read())
    return _CODECS[path]


def model_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of each whole text; null text counts as empty, which has no ids.

    Repeated rows are encoded each, an empty table gives no rows, other columns are ignored. A
    literal U+2581 is a space to the model.
    """
    path = model_path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, b in text_groups(texts):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in codec(path).stream([portions(t) for t in texts.slice(a, b - a).to_pylist()])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, text of rows doc_id, ids; null ids give null text."""
    path = model_path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [None if x.as_py() is None else codec(path).decode(np.array(x.as_py(), "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(spark: SparkSession, docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: doc_id, n_ids, ids_crc32 (ids as little-endian unsigned 32-bit), decoded_chars,
    decoded_sha256: each whole text encoded, and its ids decoded again."""
    path = model_path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], batch.column(1)
            for a, b in text_groups(texts):
                for ids in codec(path).stream([portions(t) for t in texts.slice(a, b - a).to_pylist()]):
                    back = codec(path).decode(ids)
                    rows.append((len(ids) // 4, zlib.crc32(ids), len(back), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", "n_ids", "ids_crc32", "decoded_chars", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_chars long, decoded_sha256 string")
