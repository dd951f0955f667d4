"""Byte-level BPE ids of whole texts, as little-endian uint32 bytes.

The pre-tokenizer never joins characters across a single space that is followed by a
non-space, so a text is the concatenation of independent chunks " word". Each distinct chunk
is encoded once per worker by the tokenizers library; texts with other white-space patterns or
with a special token's string go through the library as a whole. The result is the library's.
"""

from __future__ import annotations

import os
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestack.llm.work import KEPT

MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
JOINED = 64  # chunks a call of the library


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts split at each space: where each text's words begin and end, the words' numbers, and distinct words."""
    lists = pc.split_pattern(texts, " ")
    bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    distinct = lists.flatten().dictionary_encode()
    return bounds, np.array(distinct.indices), distinct.dictionary.to_pylist()


def concatenated(bounds: np.ndarray, codes: np.ndarray, ids: list[bytes]) -> list[bytes]:
    """Of each text, the ids (uint32 bytes by word number) of its words."""
    pool = np.frombuffer(b"".join(ids), "<u4")
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    each = size[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat(((np.cumsum(size) - size)[codes] - ends[:-1]).astype(np.int32), each)
    place += np.arange(ends[-1], dtype=np.int32)
    raw = pool[place].tobytes()
    cuts = (ends[bounds] * 4).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


class ChunkEncoder:
    """Bounded by cache_limit entries; once full, further chunks are encoded without being kept."""

    def __init__(self, path: str, cache_limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose text begins with a space
        for token, i in vocabulary.items():
            self.leads[i] = token.startswith("Ġ")
        self.cache: dict[str, bytes] = {}
        self.cache[""] = b""  # stands for a text's first word, which no space leads
        self.first: dict[str, bytes] = {"": b""}  # without a space before
        self.limit = cache_limit

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of " chunk" for chunks that hold no space and don't begin or end with white space."""
        parts = [" " + " ".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)]
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(e.ids for e in found)), "<u4")
        at = np.flatnonzero(self.leads[ids]) * 4
        if len(at) != len(chunks):
            raise ValueError("a chunk does not begin with exactly one token that leads with a space")
        raw, starts = ids.tobytes(), at.tolist()
        return {c: raw[x:y] for c, x, y in zip(chunks, starts, [*starts[1:], len(raw)])}

    def _new(self, need: set[str]) -> dict[str, bytes]:
        """Ids of new chunks. A known chunk that ends in a letter and marks after it are pre-tokens of their own."""
        known, ended, plain = self.cache.get, [], []
        for c in need:
            word = c.rstrip(MARKS)
            if len(word) < len(c) and word and word[-1].isalpha() and (ids := known(word)) is not None:
                ended.append((c, ids, c[len(word) :]))
            else:
                plain.append(c)
        found = self._chunks(plain) if plain else {}
        marks = {m for _, _, m in ended}.difference(self.first)
        marks = dict(zip(marks, self._whole(list(marks))))
        first = self.first.get
        for c, ids, m in ended:
            found[c] = ids + (first(m) or marks[m])
        self._keep_first(marks)
        return found

    def _keep_first(self, ids: dict[str, bytes]) -> None:
        if len(self.first) < self.limit // 8:
            self.first.update(ids)

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text. Words are split and made distinct as Arrow arrays, before Python sees them."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return []
        flags = pc.or_(pc.match_substring(texts, "  "), pc.ends_with(texts, " "))
        for special in self.specials:
            flags = pc.or_(flags, pc.match_substring(texts, special))
        whole = np.asarray(flags).copy()
        bounds, codes, words = distinct_words(texts)
        ids = list(map(self.cache.get, words))
        gaps = [k for k, v in enumerate(ids) if v is None]
        # next to a space, or at an end, white space makes runs that cross words
        odd = [k for k in gaps if (w := words[k])[0].isspace() or w[-1].isspace()]
        if odd:
            is_odd = np.zeros(len(words), bool)
            is_odd[odd] = True
            whole |= np.logical_or.reduceat(is_odd[codes], bounds[:-1])
        found = self._new({words[k] for k in gaps}.difference(words[k] for k in odd)) if gaps else {}
        for k in gaps:
            ids[k] = found.get(words[k], b"")
        heads = [words[k] for k in codes[bounds[:-1]].tolist()]
        new = set(heads).difference(self.first)
        new = dict(zip(new, self._whole(list(new))))
        first = self.first.get
        codes[bounds[:-1]] = len(words) + np.arange(len(texts))  # no space leads a text's first word
        ids += [new[h] if (v := first(h)) is None else v for h in heads]
        out = concatenated(bounds, codes, ids)
        at = np.flatnonzero(whole).tolist()
        for i, v in zip(at, self._whole([texts[i].as_py() for i in at])):
            out[i] = v
        self._keep_first(new)
        room = max(0, self.limit - len(self.cache))
        self.cache.update(found if room >= len(found) else islice(found.items(), room))
        return out


_ENCODERS: dict[str, ChunkEncoder] = KEPT.setdefault("encoders", {})


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def text_groups(texts: pa.Array | list, most: int = 8_000_000):
    """Slices (first, end) of a batch that hold at most so many bytes (characters of a list), one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist() if isinstance(texts, pa.Array) else map(len, texts)
    first = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


def batch_parts(batch: pa.RecordBatch, column: str, most: int = 8_000_000):
    """Slices of a batch whose texts hold at most so many bytes, one row at least: what is decoded at once stays small."""
    for a, b in text_groups(batch.column(batch.schema.get_field_index(column)), most):
        yield batch.slice(a, b - a)
