"""Lossless WebP: a decoder of the whole bitstream, and an encoder for pixel arrays.

The decoder reads prefix codes, back-references, colour cache and meta prefix images, and
inverts the predictor, cross-colour, subtract-green and palette transforms. Pixels are arrays of
(height, width) uint32 ARGB. Many images are decoded side by side: one step gives the next pixel
of every image, from tables of its own prefix codes; images with meta prefix codes go pixel by
pixel.

The media operator lays a text's bytes out as RGB pixels, 64 to a row, in images of at most ROWS
rows. Each image takes what makes it smallest by entropy: a transform (palette, subtract-green,
predictor), a colour cache or back-references, and prefix codes from its own counts.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.token_ids import batch_parts
from lodestack.llm.work import materialise

# Fixed values of the format: order of the code length codes, alphabet sizes, cache multiplier.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
CACHE_MULTIPLIER = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Near pixels (x left, y up) of the first 120 distance codes: nearest first, higher rows and then the left first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, -p[1], -p[0]))


_NEAR = np.array(NEAR)


class Bits:
    def __init__(self, raw: bytes):
        self.raw, self.at, self.end = raw, 0, len(raw) * 8

    def peek(self, n: int) -> int:
        byte = self.at >> 3
        return int.from_bytes(self.raw[byte : byte + 6], "little") >> (self.at & 7) & ((1 << n) - 1)

    def span(self, at: int, n: int) -> int:
        return int.from_bytes(self.raw[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        out = self.peek(n)
        self.at += n
        if self.at > self.end:
            raise ValueError("the WebP stream ends early")
        return out


@lru_cache
def reversals(n: int) -> np.ndarray:
    """Every number of n bits read backwards."""
    out = np.zeros(1, np.int64)
    for _ in range(n):
        out = np.concatenate([2 * out, 2 * out + 1])
    return out


class Prefix:
    """Canonical prefix code. uniform is its one length, if it has one for all its symbols."""

    def __init__(self, lengths: np.ndarray):
        self.symbols = np.flatnonzero(lengths)
        used = lengths[self.symbols]
        if not len(used):
            raise ValueError("a prefix code without symbols")
        self.only = int(self.symbols[0]) if len(used) == 1 else None
        self.uniform = 0 if len(used) == 1 else int(used[0]) if (used == used[0]).all() else None
        if self.only is None and int((1 << 15 >> used.astype(int)).sum()) != 1 << 15:
            raise ValueError("a prefix code is not complete")
        self.longest = 0 if self.only is not None else int(used.max())
        self.lengths = lengths
        self._table: np.ndarray | None = None
        self._list: list | None = None

    def table(self) -> np.ndarray:
        """symbol << 4 | length by the next `longest` bits of the stream."""
        if self._table is None:
            if self.only is not None:
                self._table = np.array([self.only << 4], np.int64)
            else:
                n = self.lengths[self.symbols].astype(np.int64)
                order = np.argsort(n, kind="stable")
                spread = np.repeat(self.symbols[order] << 4 | n[order], 1 << (self.longest - n[order]))
                self._table = spread[reversals(self.longest)]
        return self._table

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        if self._list is None:
            self._list = self.table().tolist()
        found = self._list[bits.peek(self.longest)]
        bits.at += found & 15
        return found >> 4


def codes(lengths: np.ndarray) -> dict[int, tuple[int, int]]:
    """symbol -> (code as it stands in the stream, length), canonical."""
    code, n = stream_codes(lengths)
    used = np.flatnonzero(lengths)
    return dict(zip(used.tolist(), zip(code[used].tolist(), n[used].tolist())))


def stream_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By symbol: code as it stands in the stream, and its length (none for a lone symbol)."""
    used = np.flatnonzero(lengths)
    code, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if len(used) > 1:
        order = used[np.argsort(lengths[used], kind="stable")]
        n[order] = lengths[order]
        longest = int(n[order[-1]])
        each = 1 << (longest - n[order])
        code[order] = reversals(longest)[np.cumsum(each) - each]
    return code, n


def read_prefix(bits: Bits, size: int) -> Prefix:
    lengths = np.zeros(size, np.uint8)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        for n in (8 if wide else 1, 8)[: 1 + two]:
            symbol = bits.read(n)
            if symbol >= size:
                raise ValueError("a prefix code has symbols beyond its alphabet")
            lengths[symbol] = 1
        return Prefix(lengths)
    of_lengths = np.zeros(19, np.uint8)
    for k in range(4 + bits.read(4)):
        of_lengths[LENGTH_ORDER[k]] = bits.read(3)
    code = Prefix(of_lengths)
    table, mask = code.table().tolist(), (1 << code.longest) - 1
    most = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    out, last = [], 8
    word, used = bits.span(bits.at, 2048), 0
    while len(out) < size and most:
        most -= 1
        if used > 2000:
            bits.at += used
            word, used = bits.span(bits.at, 2048), 0
        entry = table[word & mask]
        n, width = entry >> 4, entry & 15
        word >>= width
        used += width
        if n < 16:
            out.append(n)
            last = n or last
        else:
            least, extra, value = ((3, 2, last), (3, 3, 0), (11, 7, 0))[n - 16]
            out += [value] * (least + (word & ((1 << extra) - 1)))
            word >>= extra
            used += extra
    bits.at += used
    if len(out) > size:
        raise ValueError("code lengths run over")
    if bits.at > bits.end:
        raise ValueError("the WebP stream ends early")
    lengths[: len(out)] = out
    return Prefix(lengths)


def extended(bits: Bits, symbol: int) -> int:
    """Length or distance of a prefix symbol and its extra bits."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def read_group(bits: Bits, cache_bits: int) -> list[Prefix]:
    green = LITERALS + LENGTHS + ((1 << cache_bits) if cache_bits else 0)
    out = [read_prefix(bits, green)]
    start = bits.at
    out.append(read_prefix(bits, LITERALS))
    size = bits.at - start
    if bits.span(start, size) == bits.span(bits.at, size):  # blue has the code of red
        bits.at += size
        out.append(out[1])
    else:
        out.append(read_prefix(bits, LITERALS))
    return [*out, read_prefix(bits, LITERALS), read_prefix(bits, DISTANCES)]


def read_image(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image: width * height ARGB values in a row."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache too large")
    meta, meta_bits = None, 0
    if main and bits.read(1):
        meta_bits = bits.read(3) + 2
        w, h = ((n + (1 << meta_bits) - 1) >> meta_bits for n in (width, height))
        meta = (read_image(bits, w, h, False) >> 8 & 0xFFFF).tolist()
    groups = [read_group(bits, cache_bits) for _ in range(max(meta) + 1 if meta else 1)]
    n = width * height
    if not meta and not cache_bits and all(p.uniform is not None for p in groups[0][:4]) and groups[0][0].symbols[-1] < LITERALS:
        return _uniform(bits, groups[0], n)
    out, cache, k = [0] * n, [0] * (1 << cache_bits), 0
    shift, blocks = 32 - cache_bits, (width + (1 << meta_bits) - 1) >> meta_bits
    group = groups[0]

    def remember(c: int) -> None:
        if cache_bits:
            cache[(CACHE_MULTIPLIER * c & 0xFFFFFFFF) >> shift] = c

    while k < n:
        if meta:
            group = groups[meta[(k // width >> meta_bits) * blocks + (k % width >> meta_bits)]]
        symbol = group[0].read(bits)
        if symbol < LITERALS:
            red, blue, alpha = group[1].read(bits), group[2].read(bits), group[3].read(bits)
            out[k] = alpha << 24 | red << 16 | symbol << 8 | blue
            remember(out[k])
            k += 1
        elif symbol < LITERALS + LENGTHS:
            length = extended(bits, symbol - LITERALS)
            code = extended(bits, group[4].read(bits))
            if code > len(NEAR):
                back = code - len(NEAR)
            else:
                x, y = NEAR[code - 1]
                back = max(1, x + y * width)
            if back > k or k + length > n:
                raise ValueError("a back-reference leaves the image")
            for i in range(k, k + length):
                out[i] = out[i - back]
                remember(out[i])
            k += length
        else:
            out[k] = cache[symbol - LITERALS - LENGTHS]
            remember(out[k])
            k += 1
        if bits.at > bits.end:
            raise ValueError("the WebP stream ends early")
    return np.array(out, np.uint32)


def _uniform(bits: Bits, group: list[Prefix], n: int) -> np.ndarray:
    """Literals whose codes have one length a channel: the stream is a matrix of bits."""
    widths = [p.uniform for p in group[:4]]
    each = sum(widths)
    channel = [np.full(n, p.symbols[0], np.uint32) for p in group[:4]]
    if each:
        if bits.at + n * each > bits.end:
            raise ValueError("the WebP stream ends early")
        first = bits.at >> 3
        raw = np.frombuffer(bits.raw, np.uint8, -(-(bits.at + n * each) // 8) - first, first)
        grid = np.unpackbits(raw, bitorder="little")[bits.at - first * 8 :][: n * each].reshape(n, each)
        at = 0
        for c, (w, p) in enumerate(zip(widths, group)):
            if w:
                index = np.packbits(grid[:, at : at + w], axis=1)[:, 0] >> (8 - w)
                channel[c] = p.symbols[index].astype(np.uint32)
            at += w
        bits.at += n * each
    green, red, blue, alpha = channel
    return alpha << 24 | red << 16 | green << 8 | blue


def channels(x: np.ndarray) -> np.ndarray:
    """(..., 4) bytes: blue, green, red, alpha."""
    return np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(*x.shape, 4)


def joined(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype(np.uint8)).view("<u4")[..., 0].astype(np.uint32)


def _half(a, b):
    return (a + b) >> 1


def _select(left, top, corner):
    far_left = sum(abs(int(t) - int(c)) for t, c in zip(top, corner))
    far_top = sum(abs(int(a) - int(c)) for a, c in zip(left, corner))
    return left if far_left < far_top else top


def predicted(mode: int, left, top, right, corner):
    """Prediction of a pixel (arrays of channels) from its left, top, top right and top left."""
    if mode == 0:
        return np.array([0, 0, 0, 255])
    if mode < 5:
        return (left, top, right, corner)[mode - 1]
    if mode < 11:
        return {5: lambda: _half(_half(left, right), top), 6: lambda: _half(left, corner), 7: lambda: _half(left, top), 8: lambda: _half(corner, top), 9: lambda: _half(top, right), 10: lambda: _half(_half(left, corner), _half(top, right))}[mode]()
    if mode == 11:
        return _select(left, top, corner)
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        mean = _half(left, top)
        return np.clip(mean + np.trunc((mean - corner) / 2).astype(int), 0, 255)
    return np.array([0, 0, 0, 255])


def _predictor(pixels: np.ndarray, modes: np.ndarray, bits: int, forward: bool) -> np.ndarray:
    height, width = pixels.shape
    given = channels(pixels).astype(int)
    if (modes == modes.flat[0]).all() and modes.flat[0] in (1, 2):  # all from the left, or all from above
        first = np.array([0, 0, 0, 255])
        if forward:
            out = given.copy()
            out[:, 1:] -= given[:, :-1] if modes.flat[0] == 1 else 0
            out[0, 1:] = given[0, 1:] - given[0, :-1]
            out[1:, 0] = given[1:, 0] - given[:-1, 0]
            if modes.flat[0] == 2:
                out[1:, 1:] = given[1:, 1:] - given[:-1, 1:]
            out[0, 0] -= first
        else:
            out = given.copy()
            out[0, 0] += first
            if modes.flat[0] == 1:
                out[:, 0] = out[:, 0].cumsum(0)
                out = out.cumsum(1)
            else:
                out[0] = out[0].cumsum(0)
                out = out.cumsum(0)
        return joined(out & 255)
    out = np.zeros_like(given)
    full = given if forward else out
    for y in range(height):
        for x in range(width):
            if not y:
                p = np.array([0, 0, 0, 255]) if not x else full[0, x - 1]
            elif not x:
                p = full[y - 1, 0]
            else:
                right = full[y - 1, x + 1] if x + 1 < width else full[y, 0]
                p = predicted(int(modes[y >> bits, x >> bits]), full[y, x - 1], full[y - 1, x], right, full[y - 1, x - 1])
            out[y, x] = (given[y, x] - p if forward else given[y, x] + p) & 255
    return joined(out)


def _cross_colour(pixels: np.ndarray, elements: np.ndarray, bits: int, forward: bool) -> np.ndarray:
    height, width = pixels.shape
    e = np.repeat(np.repeat(elements, 1 << bits, 0), 1 << bits, 1)[:height, :width]
    t = channels(e).view(np.int8).astype(int)
    c = channels(pixels).astype(int)
    blue, green, red = (c[..., i] for i in range(3))

    def delta(by: np.ndarray, of: np.ndarray) -> np.ndarray:
        return by * (of & 255).astype(np.uint8).view(np.int8).astype(int) >> 5

    sign = -1 if forward else 1
    new_red = red + sign * delta(t[..., 0], green)
    c[..., 0] = blue + sign * (delta(t[..., 1], green) + delta(t[..., 2], red if forward else new_red))
    c[..., 2] = new_red
    return joined(c & 255)


def _subtract_green(pixels: np.ndarray, forward: bool) -> np.ndarray:
    c = channels(pixels).astype(int)
    c[..., [0, 2]] += (-1 if forward else 1) * c[..., 1:2]
    return joined(c & 255)


def palette_bits(size: int) -> int:
    return 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0


def _unpalette(pixels: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    bits = palette_bits(len(table))
    index = pixels >> 8 & 255
    if bits:
        x = np.arange(width)
        per = 8 >> bits
        index = index[:, x >> bits] >> (per * (x & ((1 << bits) - 1))) & ((1 << per) - 1)
    return np.concatenate([table, np.zeros(256, np.uint32)])[index]


class Opened:
    """A lossless WebP file read up to its main image."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"RIFF" or raw[8:12] != b"WEBP":
            raise ValueError("not a WebP file")
        at, data = 12, None
        while at + 8 <= len(raw):
            kind, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
            if kind == b"VP8L":
                data = raw[at + 8 : at + 8 + size]
                break
            at += 8 + size + size % 2
        if data is None or data[:1] != b"\x2f":
            raise ValueError("no lossless image in the WebP file")
        self.bits = bits = Bits(data)
        bits.at = 8
        self.width, self.height = bits.read(14) + 1, bits.read(14) + 1
        bits.read(1)
        if bits.read(3):
            raise ValueError("unknown version of the lossless bitstream")
        self.undo, self.coded = [], self.width
        while bits.read(1):
            kind = bits.read(2)
            if kind in (PREDICTOR, CROSS_COLOUR):
                b = bits.read(3) + 2
                w, h = (self.coded + (1 << b) - 1) >> b, (self.height + (1 << b) - 1) >> b
                self.undo.append((kind, read_image(bits, w, h, False).reshape(h, w), b))
            elif kind == PALETTE:
                size = bits.read(8) + 1
                table = joined(channels(read_image(bits, size, 1, False)).astype(int).cumsum(0) & 255)
                self.undo.append((kind, table, self.coded))
                self.coded = (self.coded + (1 << palette_bits(size)) - 1) >> palette_bits(size)
            else:
                self.undo.append((kind, None, 0))

    def pixels(self, coded: np.ndarray) -> np.ndarray:
        """The image from its coded pixels: the transforms are inverted, the last one first."""
        out = coded.reshape(self.height, self.coded)
        for kind, data, b in reversed(self.undo):
            if kind == PREDICTOR:
                out = _predictor(out, data >> 8 & 255, b, False)
            elif kind == CROSS_COLOUR:
                out = _cross_colour(out, data, b, False)
            elif kind == SUBTRACT_GREEN:
                out = _subtract_green(out, False)
            else:
                out = _unpalette(out, data, b)
        return out


def decode(raw: bytes) -> np.ndarray:
    """Pixels (height, width) of one lossless WebP file."""
    image = Opened(raw)
    return image.pixels(read_image(image.bits, image.coded, image.height, True))


#: How often decode_all met each feature of the bitstream, by pixels or images.
SEEN: Counter = Counter()


def decode_all(files: list[bytes]) -> list[np.ndarray]:
    """Pixels of many files, decoded side by side."""
    images = [Opened(raw) for raw in files]
    coded: list = [None] * len(images)
    side, groups, caches = [], [], []
    for i, image in enumerate(images):
        SEEN.update(("predictor", "cross-colour", "subtract-green", "palette")[kind] for kind, *_ in image.undo)
        at = image.bits.at
        cache_bits = image.bits.read(4) if image.bits.read(1) else 0
        if cache_bits > 11:
            raise ValueError("colour cache too large")
        if image.bits.read(1):
            image.bits.at = at
            coded[i] = read_image(image.bits, image.coded, image.height, True)
            SEEN["meta"] += 1
        else:
            side.append(i)
            caches.append(cache_bits)
            groups.append(read_group(image.bits, cache_bits))
    order = sorted(range(len(side)), key=lambda j: -images[side[j]].coded * images[side[j]].height)
    for j, x in zip(order, _side_by_side([images[side[j]] for j in order], [groups[j] for j in order], [caches[j] for j in order])):
        coded[side[j]] = x
    return [image.pixels(x) for image, x in zip(images, coded)]


def _side_by_side(images: list[Opened], groups: list[list[Prefix]], caches: list[int]) -> list[np.ndarray]:
    """Coded pixels of images, those with the most pixels first: step k gives pixel k of each that has one."""
    if not images:
        return []
    raw = b"".join(x.bits.raw + bytes(16) for x in images) + bytes(2048)  # what a broken image may read before the next look at its end
    starts = np.cumsum([0] + [(len(x.bits.raw) + 16) * 8 for x in images])[:-1]
    window = np.ndarray((len(raw) - 8,), "<i8", raw, strides=(1,))  # 64 bits from every byte on
    at, end = starts + [x.bits.at for x in images], starts + [x.bits.end for x in images]
    n = np.array([x.coded * x.height for x in images])
    wide = np.array([x.coded for x in images])
    tables = [[g[c].table() for g in groups] for c in range(5)]
    flat = np.concatenate([t for per in tables for t in per])
    sizes = np.array([[len(t) for t in per] for per in tables])
    base = (np.cumsum(sizes.reshape(-1)) - sizes.reshape(-1)).reshape(sizes.shape)
    mask = sizes - 1
    referring = any(g[0].symbols[-1] >= LITERALS for g in groups)
    left, back = np.zeros(len(images), np.int64), np.ones(len(images), np.int64)
    cached = np.flatnonzero(caches)
    bits = np.array(caches)
    slots = np.where(bits > 0, 1 << bits, 0)
    first = np.cumsum(slots) - slots
    cache = np.zeros(int(slots.sum()) + 1, np.int64)
    alpha = sizes[3].max() > 1
    out = np.zeros((int(n[0]), len(images)), np.uint32)
    live = len(images) - np.searchsorted(n[::-1], np.arange(n[0]), "right")  # images with more than k pixels
    fixed = (flat[base[3]] >> 4) << 24

    def symbol(c: int, word: np.ndarray, m) -> tuple[np.ndarray, np.ndarray]:
        entry = flat[base[c][m] + (word & mask[c][m])]
        return entry >> 4, entry & 15

    def extra(code: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of length and distance symbols, and how many bits follow them."""
        wide_ = np.where(code < 4, 0, (code - 2) >> 1)
        return np.where(code < 4, code + 1, ((2 + (code & 1)) << wide_) + (word & ((1 << wide_) - 1)) + 1), wide_

    for k in range(int(n[0])):
        m = slice(0, int(live[k]))
        place = at[m]
        word = window[place >> 3] >> (place & 7)
        green, used = symbol(0, word, m)
        rest = word >> used
        red, a = symbol(1, rest, m)
        rest = rest >> a
        blue, b = symbol(2, rest, m)
        step = used + a + b
        if alpha:
            top, c = symbol(3, rest >> b, m)
            pixel = top << 24 | red << 16 | green << 8 | blue
            step = step + c
        else:
            pixel = fixed[m] | red << 16 | green << 8 | blue
        if referring:
            copying = left[m] > 0
            fresh = np.zeros(len(copying), bool)
            special = np.flatnonzero((green >= LITERALS) & ~copying)
            if len(special):
                code = green[special] - LITERALS
                hit = special[code >= LENGTHS]
                pixel[hit] = cache[first[hit] + green[hit] - LITERALS - LENGTHS]
                step[hit] = used[hit]
                ref = special[code < LENGTHS]
                if len(ref):
                    length, more = extra(green[ref] - LITERALS, word[ref] >> used[ref])
                    here = place[ref] + used[ref] + more
                    ahead = window[here >> 3] >> (here & 7)
                    entry = flat[base[4][ref] + (ahead & mask[4][ref])]
                    far, most = extra(entry >> 4, ahead >> (entry & 15))
                    near = _NEAR[np.minimum(far, len(NEAR)) - 1]
                    far = np.where(far > len(NEAR), far - len(NEAR), np.maximum(1, near[:, 0] + near[:, 1] * wide[ref]))
                    if (far > k).any() or (k + length > n[ref]).any():
                        raise ValueError("a back-reference leaves the image")
                    left[ref], back[ref] = length, far
                    step[ref] = here + (entry & 15) + most - place[ref]
                    copying[ref] = fresh[ref] = True
                    SEEN["references"] += len(ref)
                SEEN["cache"] += len(hit)
            if copying.any():
                of = np.flatnonzero(copying)
                pixel[of] = out[k - back[of], of]
                step[of] = np.where(fresh[of], step[of], 0)
                left[of] -= 1
        if len(cached):
            own = cached[cached < m.stop]
            cache[first[own] + ((CACHE_MULTIPLIER * pixel[own] & 0xFFFFFFFF) >> (32 - bits[own]))] = pixel[own]
        out[k, m] = pixel
        at[m] += step
        if (k & 255) == 255 and (at > end).any():
            raise ValueError("the WebP stream ends early")
    if (at > end).any():
        raise ValueError("the WebP stream ends early")
    return [out[:k, i].copy() for i, k in enumerate(n.tolist())]


# --- encoder ---------------------------------------------------------------------------------


class Writer:
    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def bytes(self) -> bytes:
        return self.value.to_bytes(-(-self.n // 8), "little")


def code_lengths(count: Counter | np.ndarray, size: int, most: int = 15) -> np.ndarray:
    """Lengths of an optimal prefix code, made flatter until none exceeds most."""
    if isinstance(count, Counter):
        given = np.zeros(size, np.int64)
        for s, n in count.items():
            given[s] = n
        count = given
    out = np.zeros(size, np.uint8)
    symbols = np.flatnonzero(count)
    if len(symbols) < 2:
        out[symbols[0] if len(symbols) else 0] = 1
        return out
    symbols = symbols[np.argsort(count[symbols], kind="stable")]
    weight = count[symbols].tolist()
    n = len(weight)
    while True:
        made, parent, i, j = list(weight), [0] * (2 * n - 1), 0, n
        for new in range(n, 2 * n - 1):  # leaves and sums are both ascending
            if i < n and (j >= new or made[i] <= made[j]):
                parent[i] = new
                total, i = made[i], i + 1
            else:
                parent[j] = new
                total, j = made[j], j + 1
            if i < n and (j >= new or made[i] <= made[j]):
                parent[i] = new
                total, i = total + made[i], i + 1
            else:
                parent[j] = new
                total, j = total + made[j], j + 1
            made.append(total)
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            break
        weight = [(w >> 1) + 1 for w in weight]
    out[symbols] = depth[:n]
    return out


def write_prefix(w: Writer, lengths: np.ndarray) -> None:
    w.put(*prefix_bits(lengths))


#: Typical numbers of the symbols that code lengths are written with (a code for those up to 15, one for those up to 12).
TYPICAL = (24, 1, 4, 8, 12, 20, 28, 40, 40, 40, 40, 30, 20, 1, 1, 1, 8, 30, 24)


@lru_cache
def _length_code(longest: int) -> tuple[int, int, list[int], list[int]]:
    """Head of a prefix code (bits, their number), and codes and sizes of code length symbols."""
    lengths = code_lengths(np.array([n if k <= longest or k > 15 else 0 for k, n in enumerate(TYPICAL)]), 19, 7)
    shown = max(4, 1 + max(k for k in range(19) if lengths[LENGTH_ORDER[k]]))
    value, n = (shown - 4) << 1, 5
    for k in range(shown):
        value |= int(lengths[LENGTH_ORDER[k]]) << n
        n += 3
    code, size = (x.tolist() for x in stream_codes(lengths))
    return value, n, code, size


def prefix_bits(lengths: np.ndarray) -> tuple[int, int]:
    """A prefix code as it stands in the stream: bits, and their number."""
    used = np.flatnonzero(lengths)
    first, last = int(used[0]), int(used[-1])
    if len(used) <= 2 and last < 256:
        return (1 | 1 << 2 | first << 3, 11) if len(used) == 1 else (1 | 1 << 1 | 1 << 2 | first << 3 | last << 11, 19)
    some = lengths[: last + 1]
    cuts = np.flatnonzero(some[1:] != some[:-1]) + 1
    value, n, code, size = _length_code(12 if some.max() <= 12 else 15)
    body = at = tokens = start = 0
    for stop in (*cuts.tolist(), last + 1):
        v, run, start = int(some[start]), stop - start, stop
        if v:
            body |= code[v] << at
            at += size[v]
            tokens += 1
            run -= 1
            while run >= 3:
                k = min(run, 6)
                body |= (code[16] | (k - 3) << size[16]) << at
                at += size[16] + 2
                tokens += 1
                run -= k
        else:
            while run >= 3:
                k = min(run, 138)
                symbol, extra, more = (18, k - 11, 7) if k >= 11 else (17, k - 3, 3)
                body |= (code[symbol] | extra << size[symbol]) << at
                at += size[symbol] + more
                tokens += 1
                run -= k
        for _ in range(run):
            body |= code[v] << at
            at += size[v]
            tokens += 1
    if last + 1 < len(lengths) and tokens > 1:  # lengths behind the last token are zero
        wide = next(x for x in range(2, 17, 2) if tokens - 2 < 1 << x)
        value |= (1 | (wide - 2) // 2 << 1 | (tokens - 2) << 4) << n
        n += 4 + wide
    else:
        n += 1
        while last + 1 < len(lengths):  # one token alone: zeros to the end
            run = min(138, len(lengths) - last - 1)
            symbol, extra, more = (18, run - 11, 7) if run >= 11 else (17, run - 3, 3) if run >= 3 else (0, 0, 0)
            body |= (code[symbol] | extra << size[symbol]) << at
            at += size[symbol] + more
            last += run if run >= 3 else 1
    return value | body << n, n + at


def _split(value: int) -> tuple[int, int, int]:
    """Prefix symbol, extra bits and their number, of a length or distance."""
    value -= 1
    if value < 4:
        return value, 0, 0
    high = value.bit_length() - 1
    second = value >> (high - 1) & 1
    return 2 * high + second, value & ((1 << (high - 1)) - 1), high - 1


def _tokens(pixels: list[int], width: int, cache_bits: int, references: bool) -> list[tuple]:
    """Literals, (length, distance code) references to the last like pair of pixels, cache hits."""
    near = {max(1, x + y * width): i + 1 for i, (x, y) in reversed(list(enumerate(NEAR))) if x + y * width > 0}
    out, seen, cache, k, n = [], {}, {}, 0, len(pixels)
    while k < n:
        length = 0
        if references and k + 3 < n and (j := seen.get((pixels[k], pixels[k + 1]))) is not None:
            while k + length < n and length < 4096 and pixels[j + length] == pixels[k + length]:
                length += 1
        if length >= 3:
            out.append(("copy", length, near.get(k - j, k - j + len(NEAR))))
        else:
            length = 1
            slot = (CACHE_MULTIPLIER * pixels[k] & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
            out.append(("cache", slot) if cache_bits and cache.get(slot) == pixels[k] else ("pixel", pixels[k]))
        for i in range(k, k + length):
            if cache_bits:
                cache[(CACHE_MULTIPLIER * pixels[i] & 0xFFFFFFFF) >> (32 - cache_bits)] = pixels[i]
            if i + 1 < n:
                seen[pixels[i], pixels[i + 1]] = i
        k += length
    return out


def write_image(w: Writer, pixels: np.ndarray, main: bool, cache_bits: int = 0, references: bool = False, meta: tuple[int, np.ndarray] | None = None) -> None:
    height, width = pixels.shape
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    if main:
        w.put(int(meta is not None), 1)
        if meta is not None:
            w.put(meta[0] - 2, 3)
            write_image(w, meta[1].astype(np.uint32) << 8, False)
    tokens = _tokens(pixels.reshape(-1).tolist(), width, cache_bits, references)
    size = (LITERALS + LENGTHS + ((1 << cache_bits) if cache_bits else 0), LITERALS, LITERALS, LITERALS, DISTANCES)
    k, rows = 0, []
    for t in tokens:
        group = 0 if meta is None else int(meta[1][k // width >> meta[0], k % width >> meta[0]])
        if t[0] == "pixel":
            p = t[1]
            rows.append((group, [(0, p >> 8 & 255), (1, p >> 16 & 255), (2, p & 255), (3, p >> 24)], None))
            k += 1
        elif t[0] == "cache":
            rows.append((group, [(0, LITERALS + LENGTHS + t[1])], None))
            k += 1
        else:
            a, b = _split(t[1]), _split(t[2])
            rows.append((group, [(0, LITERALS + a[0]), (4, b[0])], (a[1:], b[1:])))
            k += t[1]
    groups = 1 if meta is None else int(meta[1].max()) + 1
    count = [[Counter() for _ in range(5)] for _ in range(groups)]
    for g, symbols, _ in rows:
        for c, s in symbols:
            count[g][c][s] += 1
    table = []
    for g in range(groups):
        lengths = [code_lengths(count[g][c], size[c]) for c in range(5)]
        for x in lengths:
            write_prefix(w, x)
        table.append([codes(x) for x in lengths])
    for g, symbols, extra in rows:
        for i, (c, s) in enumerate(symbols):
            w.put(*table[g][c][s])
            if extra:
                w.put(*extra[i])


def _file(data: bytes) -> bytes:
    data += b"\0" * (len(data) % 2)
    size = len(data)
    return b"RIFF" + struct.pack("<I", size + 12) + b"WEBPVP8L" + struct.pack("<I", size) + data


def write_transforms(w: Writer, pixels: np.ndarray, transforms: list[tuple]) -> np.ndarray:
    """Coded pixels after the transforms, which are written with their data."""
    for kind, *rest in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits, blocks = rest
            w.put(bits - 2, 3)
            write_image(w, (blocks.astype(np.uint32) << 8) if kind == PREDICTOR else blocks, False)
            pixels = (_predictor if kind == PREDICTOR else _cross_colour)(pixels, blocks, bits, True)
        elif kind == PALETTE:
            table, index = np.unique(pixels, return_inverse=True)
            w.put(len(table) - 1, 8)
            c = channels(table).astype(int)
            write_image(w, joined(np.diff(c, axis=0, prepend=0) & 255)[None], False)
            bits = palette_bits(len(table))
            index = index.reshape(pixels.shape)
            across = (pixels.shape[1] + (1 << bits) - 1) >> bits
            packed = np.zeros((len(pixels), across), np.uint32)
            for x in range(pixels.shape[1]):
                packed[:, x >> bits] |= index[:, x].astype(np.uint32) << ((8 >> bits) * (x & ((1 << bits) - 1)))
            pixels = packed << 8
        else:
            pixels = _subtract_green(pixels, True)
    return pixels


def encode(pixels: np.ndarray, transforms: list[tuple] = (), cache_bits: int = 0, references: bool = True, meta: tuple[int, np.ndarray] | None = None) -> bytes:
    """A lossless WebP file of pixels (height, width).

    transforms, in the order they are applied: (PREDICTOR, bits, modes), (CROSS_COLOUR, bits,
    elements), (SUBTRACT_GREEN,) and (PALETTE,). meta: (bits, number of the code group of each block).
    """
    height, width = pixels.shape
    w = Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(int((pixels >> 24 != 255).any()), 1)
    w.put(0, 3)
    pixels = write_transforms(w, pixels, transforms)
    w.put(0, 1)
    write_image(w, pixels, True, cache_bits, references, meta)
    return _file(w.bytes())


# --- texts as media --------------------------------------------------------------------------

UNIT, WIDTH, ROWS = 192, 64, 32
#: Longest prefix code of a stored text, and bits of its colour cache where it has one.
LONGEST, CACHE = 12, 7
OPAQUE = np.uint32(255 << 24)


_LOG = np.arange(1 << 16, dtype=float)
_LOG[1:] *= np.log2(_LOG[1:])


def entropy(counts: np.ndarray) -> float:
    """Bits that so many symbols, fewer than 65,536, take without the code's own."""
    return float(_LOG[counts.sum()] - _LOG[counts].sum())


def _counts(pixels: np.ndarray) -> list[np.ndarray]:
    """Counts of green, red and blue."""
    c = channels(pixels.reshape(-1))
    return [np.bincount(c[:, i], minlength=LITERALS) for i in (1, 2, 0)]


def transforms_for(pixels: np.ndarray) -> list[tuple]:
    """The transform that makes an image smallest by entropy, if one does."""
    height, width = pixels.shape
    flat = pixels.reshape(-1)
    alike = np.count_nonzero(flat[1:] == flat[:-1]) + np.count_nonzero(flat[width:] == flat[:-width])
    c = channels(flat)
    if 10 * alike <= len(flat) and 10 * np.count_nonzero(c[:, 0] == c[:, 1]) <= len(flat):
        return []
    found = [(sum(map(entropy, _counts(pixels))), [])]
    if 10 * alike > len(flat):
        colours, n = np.unique(pixels, return_counts=True)
        if len(colours) <= 256:  # a table's entries take about 18 bits
            found.append((18 * len(colours) + entropy(n) + 60, [(PALETTE,)]))
        for mode in (1, 2):
            modes = np.full(((height + 511) >> 9, (width + 511) >> 9), mode, np.uint32)
            found.append((sum(map(entropy, _counts(_predictor(pixels, modes, 9, True)))) + 60, [(PREDICTOR, 9, modes)]))
    found.append((sum(map(entropy, _counts(_subtract_green(pixels, True)))) + 3, [(SUBTRACT_GREEN,)]))
    return min(found, key=lambda x: x[0])[1]


def cache_hits(pixels: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each pixel in a colour cache, and whether the cache holds the pixel when it comes."""
    slot = (CACHE_MULTIPLIER * pixels.astype(np.int64) & 0xFFFFFFFF) >> (32 - bits)
    order = np.argsort(slot, kind="stable")
    hit = np.zeros(len(pixels), bool)
    hit[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (pixels[order[1:]] == pixels[order[:-1]])
    return slot, hit


def repeats(pixels: np.ndarray) -> int:
    """Runs of three pixels that an earlier place has too."""
    if len(pixels) < 6:
        return 0
    x = pixels * np.uint32(0x9E3779B1)
    key = np.sort((x[:-2] * np.uint32(0x85EBCA6B) ^ x[1:-1]) * np.uint32(0xC2B2AE35) ^ x[2:])  # two keys are equal by chance once in millions
    return np.count_nonzero(key[1:] == key[:-1])


def _stream(values: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Bits of values one after another, lowest first."""
    each = np.repeat(values, widths)
    each >>= np.arange(len(each)) - np.repeat(np.cumsum(widths) - widths, widths)
    return (each & 1).astype(np.uint8)


def _literals(pixels: np.ndarray) -> tuple[list[np.ndarray], bool, np.ndarray, np.ndarray]:
    """Counts of green, red and blue, whether there is a cache, and alphabets and symbols in stream order."""
    c = channels(pixels)
    counts = _counts(pixels)
    slot, hit = cache_hits(pixels, CACHE)
    best, cached = sum(map(entropy, counts)), False
    if 8 * hit.sum() > len(pixels):
        kept = _counts(pixels[~hit])
        green = np.concatenate([kept[0], np.zeros(LENGTHS, int), np.bincount(slot[hit], minlength=1 << CACHE)])
        if sum(map(entropy, (green, *kept[1:]))) + 5 * min(hit.sum(), 1 << CACHE) < best:
            counts, cached = [green, *kept[1:]], True
    symbols = np.stack([c[:, 1], c[:, 2], c[:, 0]], 1).astype(np.int64)
    places = np.tile(np.arange(3), (len(pixels), 1))
    if cached:
        symbols[hit, 0] = LITERALS + LENGTHS + slot[hit]
        places[hit, 1:] = -1
    keep = places.reshape(-1) >= 0
    return counts, cached, places.reshape(-1)[keep], symbols.reshape(-1)[keep]


_ALPHA = np.zeros(LITERALS, np.uint8)
_ALPHA[255] = 1
_ALPHA_BITS, _NO_DISTANCE = prefix_bits(_ALPHA), prefix_bits(np.array([1] + [0] * (DISTANCES - 1), np.uint8))


def write_best(w: Writer, pixels: np.ndarray) -> np.ndarray:
    """Header of the main image into w; the bits of its pixels: literals with cache hits, or back-references."""
    width, pixels = pixels.shape[1], pixels.reshape(-1)
    if repeats(pixels) * 4 > len(pixels):
        tokens = _tokens(pixels.tolist(), width, 0, True)
        count = [np.zeros(n, np.int64) for n in (LITERALS + LENGTHS, LITERALS, LITERALS, LITERALS, DISTANCES)]
        rows = []  # (alphabet, symbol, extra bits, their number)
        for t in tokens:
            if t[0] == "pixel":
                rows += [(0, t[1] >> 8 & 255, 0, 0), (1, t[1] >> 16 & 255, 0, 0), (2, t[1] & 255, 0, 0)]
            else:
                rows += [(i, base + x[0], x[1], x[2]) for i, base, x in ((0, LITERALS, _split(t[1])), (4, 0, _split(t[2])))]
        place, symbol, value, more = np.array(rows, np.int64).T
        for i in (0, 1, 2, 4):
            count[i] += np.bincount(symbol[place == i], minlength=len(count[i]))
        w.put(0, 2)  # no cache, no meta image
    else:
        found, cached, place, symbol = _literals(pixels)
        count = [np.pad(found[0], (0, max(0, LITERALS + LENGTHS - len(found[0])))), *found[1:]]
        value = more = None
        w.put(int(cached) | CACHE << 1 if cached else 0, 5 if cached else 1)
        w.put(0, 1)
    both = count[1] + count[2]
    one = entropy(both) <= 1.01 * (entropy(count[1]) + entropy(count[2])) + 200  # red and blue with one code
    red = code_lengths(both if one else count[1], LITERALS, LONGEST)
    lengths = [code_lengths(count[0], len(count[0]), LONGEST), red, red if one else code_lengths(count[2], LITERALS, LONGEST)]
    if len(count) > 4:
        lengths += [_ALPHA, code_lengths(count[4], DISTANCES, LONGEST)]
    made = [prefix_bits(x) for x in (lengths[:2] if one else lengths[:3])]
    for x in (*made[:2], made[-1], _ALPHA_BITS, prefix_bits(lengths[4]) if len(count) > 4 else _NO_DISTANCE):
        w.put(*x)
    pairs = [stream_codes(x) for x in (lengths[:2] if one else lengths)]
    if one:
        pairs += [pairs[1], *map(stream_codes, lengths[3:])]
    starts = np.cumsum([0] + [len(x) for x in lengths])[:-1]
    code, n = (np.concatenate(x) for x in zip(*pairs))
    at = starts[place] + symbol
    if value is None:
        return _stream(code[at], n[at])
    return _stream(np.stack([code[at], value], 1).reshape(-1), np.stack([n[at], more], 1).reshape(-1))


def image_of(payload: bytes) -> bytes:
    """A WebP file whose pixels, in reading order, have the payload's bytes as red, green, blue."""
    data = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, 3).astype(np.uint32)
    pixels = OPAQUE | data[..., 0] << 16 | data[..., 1] << 8 | data[..., 2]
    w = Writer()
    w.put(0x2F, 8)
    w.put(WIDTH - 1, 14)
    w.put(len(pixels) - 1, 14)
    w.put(0, 1 + 3)  # no alpha, version 0
    coded = write_transforms(w, pixels, transforms_for(pixels))
    w.put(0, 1)
    body = write_best(w, coded)
    head = np.unpackbits(np.frombuffer(w.bytes(), np.uint8), bitorder="little")[: w.n]
    return _file(np.packbits(np.concatenate([head, body]), bitorder="little").tobytes())


def store(payload: bytes) -> bytes:
    """Payload, a positive multiple of 192 bytes, as WebP files of at most ROWS rows one after another."""
    step = ROWS * UNIT
    return b"".join(image_of(payload[i : i + step]) for i in range(0, len(payload), step))


def files_of(media: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(media):
        size = struct.unpack_from("<I", media, at + 4)[0] + 8
        out.append(media[at : at + size])
        at += size
    return out


def load_all(media: list[bytes]) -> list[np.ndarray]:
    """Pixels of all images of each stored payload."""
    files = [files_of(x) for x in media]
    pixels = iter(decode_all([f for per in files for f in per]))
    return [np.concatenate([next(pixels) for _ in per]) for per in files]


def load(media: bytes) -> np.ndarray:
    """Pixels of all images of a stored payload."""
    return load_all([media])[0]


def payload_of(pixels: np.ndarray) -> bytes:
    return channels(pixels)[..., [2, 1, 0]].tobytes()


def feature(pixels: np.ndarray) -> str:
    """Mean red, green and blue, and a 64-bit hash: which of 64 equal spans of pixels are brighter than the mean."""
    c = channels(pixels)[..., :3].reshape(-1, 3)
    mean = c.sum(0, dtype=np.int64) / len(c)
    cut = np.arange(64) * len(c) // 64
    light = np.add.reduceat(c.sum(1, dtype=np.int64), cut) / np.diff(np.append(cut, len(c)))
    bits = int("".join("01"[int(x > mean.sum())] for x in light), 2)
    return ",".join(f"{x:.3f}" for x in mean[::-1]) + f",{bits:016x}"


RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def write_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text stored as WebP. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch_parts(batch, "text", 2_000_000):
                raw = [t.encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                media = [store(r + b" " * (max(UNIT, -(-len(r) // UNIT) * UNIT) - len(r))) for r in raw]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def read_media(stored: DataFrame) -> DataFrame:
    """Pixels of every stored text, and from them its payload's digests and its feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_parts(whole, "media", 2_000_000)):
            rows = []
            ids, sizes, files = (c.to_pylist() for c in batch.columns)
            for doc_id, n, media, pixels in zip(ids, sizes, files, load_all(files)):
                payload = payload_of(pixels)
                rows.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(pixels)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in RESULT.split(", ")])

    return stored.mapInArrow(run, RESULT)


def media_columns(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Store every whole text as lossless WebP, read the stored bytes back, return digests and features.

    Empty and null texts are one unit of blanks; repeated rows are stored each; texts of more
    than ROWS rows of pixels become several images; a text of more than 2 GB, which neither Arrow
    nor Parquet holds as one value, raises when it is read; an empty table gives no rows; columns
    but doc_id and text are not read.
    """
    return read_media(materialise(write_media(docs), "media"))
