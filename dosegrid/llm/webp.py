"""Lossless WebP: a reader for the whole format and a writer, in numpy.

Pixels are uint32 numbers 0xAARRGGBB. `read_many` decodes the main images of many
files side by side, a symbol of each at a step: literals, back-references and colour
cache; files with codes or groups beyond that, and the last files of a batch, are
decoded one by one. Then predictor, cross-colour, green and palette transforms are
undone. `write` takes for each image the transform, back-references and cache that its
content makes cheapest.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
LITERALS, LENGTHS, DISTANCES, CACHE_FACTOR = 256, 24, 40, 0x1E35A7BD
BLACK = 0xFF000000
#: Close pixels by rising distance: (x to the left, y up).
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))
#: Longest code that the writer uses and the side-by-side reader takes; files that are read side by side, and so few that one by one is faster.
SHORT, ABREAST, FEW = 11, 4096, 96
#: The writer's shortest back-reference, its cache, and hits that pay for one.
LEAST_COPY, CACHE_BITS, LEAST_HITS = 3, 8, 64


class Bits:
    """Reads bits, lowest first; past the end there are zeros."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def look(self) -> int:
        """At least 57 bits from here on."""
        return int.from_bytes(self.data[self.at >> 3 : (self.at >> 3) + 8], "little") >> (self.at & 7)

    def take(self, n: int) -> int:
        out = self.look() & (1 << n) - 1
        self.at += n
        return out


class Code:
    """A canonical prefix code by its lengths. A single symbol takes no bits."""

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.last = int(used[-1]) if len(used) else 0
        self.only = self.last if len(used) < 2 else None
        self.longest = 0
        if self.only is None:
            self.used, self.size = used, lengths[used].astype(np.int64)
            self.longest = n = int(self.size.max())
            if (np.int64(1) << n - self.size).sum() != 1 << n:
                raise ValueError("a prefix code is not complete")
            self.fast = None

    @property
    def table(self) -> np.ndarray:
        """By the next bits, as many as the longest code has: length << 16 | symbol."""
        order = np.argsort(self.size, kind="stable")
        size = self.size[order]
        return np.repeat(size << 16 | self.used[order], np.int64(1) << self.longest - size)[_mirrored(self.longest)]

    def entries(self) -> list[int]:
        if self.fast is None:
            self.fast = self.table.tolist()
        return self.fast

    def take(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        entry = self.entries()[bits.look() & (1 << self.longest) - 1]
        bits.at += entry >> 16
        return entry & 0xFFFF


_mirror_memo: dict[int, np.ndarray] = {}


def _mirrored(n: int) -> np.ndarray:
    """Every number of n bits with its bits in opposite order."""
    if n not in _mirror_memo:
        x, out = np.arange(1 << n), np.zeros(1 << n, np.int64)
        for k in range(n):
            out |= (x >> k & 1) << n - 1 - k
        _mirror_memo[n] = out
    return _mirror_memo[n]


@lru_cache(64)
def _of_lengths(first: bytes) -> Code:
    """The code for code lengths; files of one writer share it."""
    return Code(np.frombuffer(first, np.int64))


def read_codes(bits: Bits, sizes: tuple[int, ...]) -> list[Code]:
    """Codes of alphabets of these sizes. Where the bits of the code before come again, so does the code."""
    out, value, n, size, counted = [], 0, 0, 0, False
    for symbols in sizes:
        at = bits.at
        if n and (counted or symbols == size) and _span(bits, n) == value:
            out.append(out[-1])
            bits.at += n
            continue
        code, counted = read_code(bits, symbols)
        out.append(code)
        n, size = bits.at - at, symbols
        bits.at = at
        value = _span(bits, n)
        bits.at += n
        counted = counted and code.last < min(sizes[1:4])
    return out


def _span(bits: Bits, n: int) -> int:
    """The next n bits as a number."""
    return int.from_bytes(bits.data[bits.at >> 3 : (bits.at + n + 7 >> 3)], "little") >> (bits.at & 7) & (1 << n) - 1


def read_code(bits: Bits, symbols: int) -> tuple[Code, bool]:
    """A code, and whether its bits say themselves where they end."""
    lengths = np.zeros(symbols, np.int64)
    if bits.take(1):
        two, wide = bits.take(1), bits.take(1)
        lengths[bits.take(8 if wide else 1)] = 1
        if two:
            lengths[bits.take(8)] = 1
        return Code(lengths), True
    first = np.zeros(19, np.int64)
    n = 4 + bits.take(4)
    v = bits.look()  # 57 bits, all that there can be
    first[list(CODE_LENGTH_ORDER[:n])] = [v >> 3 * k & 7 for k in range(n)]
    bits.at += 3 * n
    code = _of_lengths(first.tobytes())
    counted = bool(bits.take(1))
    left = 2 + bits.take(2 + 2 * bits.take(3)) if counted else symbols
    at, before, used = 0, 8, 0
    rest, until = 0, 0  # bits from here on, which are enough for a symbol until so many are used; none takes more than 14
    fast, mask, only = (None, 0, code.only) if code.only is not None else (code.entries(), (1 << code.longest) - 1, 0)
    values = [0] * symbols
    while at < symbols and left:
        left -= 1
        if used >= until:
            rest, until = int.from_bytes(bits.data[bits.at + used >> 3 : (bits.at + used >> 3) + 30], "little") >> (bits.at + used & 7), used + 218
        entry = fast[rest & mask] if fast else only
        n, s = entry >> 16, entry & 0xFFFF
        rest >>= n
        used += n
        if s < 16:
            values[at] = s
            at, before = at + 1, s or before
        else:
            least, more = ((3, 2), (3, 3), (11, 7))[s - 16]
            n = least + (rest & (1 << more) - 1)
            rest >>= more
            used += more
            if at + n > symbols:
                raise ValueError("code lengths run over the alphabet")
            if s == 16:
                values[at : at + n] = [before] * n
            at += n
    bits.at += used
    return Code(np.array(values)), counted


def _value(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    extra = prefix - 2 >> 1
    return (2 + (prefix & 1) << extra) + bits.take(extra) + 1


@dataclass
class Coded:
    """What stands before the pixels of an entropy-coded image: its codes by group, and the group of each block."""

    width: int
    height: int
    cache_bits: int
    codes: list[list[Code]]
    of_block: np.ndarray | None
    shift: int


def _read_coded(bits: Bits, width: int, height: int, main: bool) -> Coded:
    cache_bits = bits.take(4) if bits.take(1) else 0
    shift, groups, of_block = 0, 1, None
    if main and bits.take(1):
        shift = bits.take(3) + 2
        of_block = _entropy_image(bits, -(-width >> shift), -(-height >> shift), False) >> 8 & 0xFFFF
        groups = int(of_block.max()) + 1
    sizes = (LITERALS + LENGTHS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCES)
    return Coded(width, height, cache_bits, [read_codes(bits, sizes) for _ in range(groups)], of_block, shift)


def _pixels(bits: Bits, head: Coded, out: list[int]) -> np.ndarray:
    """The image, whose first pixels are in out already."""
    width, cache_bits, of_block = head.width, head.cache_bits, head.of_block
    size, cached, cache = width * head.height, 0, [0] * (1 << cache_bits)
    if of_block is None and head.codes[0][0].only is None and sum(c.longest for c in head.codes[0][:4]) <= 57:  # literals one after the other
        (g, gm), (r, rm), (b, bm), (a, am) = ((c.entries(), (1 << c.longest) - 1) if c.only is None else ([c.only], 0) for c in head.codes[0][:4])
    else:
        g = None
    while len(out) < size:
        if g is not None:
            data, p, n = bits.data, bits.at, len(out)
            while n < size:
                v = int.from_bytes(data[p >> 3 : (p >> 3) + 8], "little") >> (p & 7)
                e = g[v & gm]
                green = e & 0xFFFF
                if green >= LITERALS:
                    break
                k = e >> 16
                v >>= k
                red = r[v & rm]
                v >>= red >> 16
                blue = b[v & bm]
                v >>= blue >> 16
                alpha = a[v & am]
                p += k + (red >> 16) + (blue >> 16) + (alpha >> 16)
                out.append((alpha & 0xFF) << 24 | (red & 0xFF) << 16 | green << 8 | blue & 0xFF)
                n += 1
            bits.at = p
            if n == size:
                break
        at = len(out)
        green, red, blue, alpha, far = head.codes[of_block[at // width >> head.shift, at % width >> head.shift] if of_block is not None else 0]
        s = green.take(bits)
        if s < LITERALS:
            pixel = s << 8 | red.take(bits) << 16
            out.append(pixel | blue.take(bits) | alpha.take(bits) << 24)
        elif s < LITERALS + LENGTHS:
            n = _value(bits, s - LITERALS)
            d = _value(bits, far.take(bits))
            if d > len(NEAR):
                d -= len(NEAR)
            else:
                x, y = NEAR[d - 1]
                d = max(1, x + y * width)
            if d > at or at + n > size:
                raise ValueError("a back-reference leaves the image")
            for k in range(at, at + n):
                out.append(out[k - d])
        else:
            for pixel in out[cached:]:
                cache[(CACHE_FACTOR * pixel & 0xFFFFFFFF) >> 32 - cache_bits] = pixel
            cached = at
            out.append(cache[s - LITERALS - LENGTHS])
    return np.array(out, np.uint32).reshape(head.height, width)


def _entropy_image(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    return _pixels(bits, _read_coded(bits, width, height, main), [])


def _split(pixels: np.ndarray) -> np.ndarray:
    """Channels A, R, G, B as a last axis of int32."""
    return np.stack([pixels >> np.uint32(k) & np.uint32(255) for k in (24, 16, 8, 0)], -1).astype(np.int32)


def _join(channels: np.ndarray) -> np.ndarray:
    c = channels.astype(np.uint32) & np.uint32(255)
    return c[..., 0] << np.uint32(24) | c[..., 1] << np.uint32(16) | c[..., 2] << np.uint32(8) | c[..., 3]


def _predicted(mode: int, left: np.ndarray, top: np.ndarray, right: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """left, top, top right and top left neighbours, all of channels."""
    mean = lambda a, b: a + b >> 1
    if mode == 11:
        guess = left + top - corner
        return left if abs(guess - left).sum() < abs(guess - top).sum() else top
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        middle = mean(left, top)
        return np.clip(middle + np.trunc((middle - corner) / 2).astype(np.int32), 0, 255)
    return {
        1: lambda: left, 2: lambda: top, 3: lambda: right, 4: lambda: corner, 5: lambda: mean(mean(left, right), top), 6: lambda: mean(left, corner), 7: lambda: mean(left, top),
        8: lambda: mean(corner, top), 9: lambda: mean(top, right), 10: lambda: mean(mean(left, corner), mean(top, right)),
    }.get(mode, lambda: np.array([255, 0, 0, 0]))()


def _undo_predictor(pixels: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    height, width = pixels.shape
    out = _split(pixels)
    mode_of = modes >> 8 & 15
    out[0, 0, 0] += 255
    out[0] = np.cumsum(out[0], 0)
    if (mode_of == 1).all() or (mode_of == 2).all():  # neighbours on one side only: running sums
        if mode_of.flat[0] == 2:
            return _join(np.cumsum(out, 0))
        out[:, 0] = np.cumsum(out[:, 0], 0)
        out[1:] = np.cumsum(out[1:], 1)
        return _join(out)
    out &= 255
    out = out.reshape(-1, 4)
    for at in range(width, len(out)):
        y, x = divmod(at, width)
        guess = out[at - width] if not x else _predicted(int(mode_of[y >> shift, x >> shift]), out[at - 1], out[at - width], out[at - width + 1], out[at - width - 1])
        out[at] = out[at] + guess & 255
    return _join(out).reshape(height, width)


def _undo_cross_colour(pixels: np.ndarray, blocks: np.ndarray, shift: int) -> np.ndarray:
    height, width = pixels.shape
    c = _split(pixels)
    t = _split(blocks)[np.arange(height)[:, None] >> shift, np.arange(width)[None] >> shift].astype(np.uint8).view(np.int8).astype(np.int32)
    signed = lambda x: x.astype(np.uint8).view(np.int8).astype(np.int32)
    red = c[..., 1] + (t[..., 3] * signed(c[..., 2]) >> 5) & 255
    blue = c[..., 3] + (t[..., 2] * signed(c[..., 2]) >> 5) + (t[..., 1] * signed(red) >> 5) & 255
    return _join(np.stack([c[..., 0], red, c[..., 2], blue], -1))


def _undo_subtract_green(pixels: np.ndarray) -> np.ndarray:
    green = pixels >> np.uint32(8) & np.uint32(255)
    both = (pixels & np.uint32(0xFF00FF)) + (green << np.uint32(16) | green) & np.uint32(0xFF00FF)
    return pixels & np.uint32(0xFF00FF00) | both


def _undo_palette(pixels: np.ndarray, palette: np.ndarray, shift: int, width: int) -> np.ndarray:
    index = pixels >> np.uint32(8) & np.uint32(255)
    if shift:
        each = 8 >> shift
        parts = index[..., None] >> (np.arange(1 << shift, dtype=np.uint32) * np.uint32(each)) & np.uint32((1 << each) - 1)
        index = parts.reshape(len(pixels), -1)[:, :width]
    full = np.zeros(256, np.uint32)
    full[: len(palette)] = palette
    return full[index]


def chunk(data: bytes) -> bytes:
    """The lossless stream in a WebP file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("no WebP file")
    at = 12
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        if name == b"VP8L":
            return data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no lossless stream")


def _head(bits: Bits) -> tuple[int, int]:
    if bits.take(8) != 0x2F:
        raise ValueError("no lossless signature")
    width, height = bits.take(14) + 1, bits.take(14) + 1
    bits.take(1)
    if bits.take(3):
        raise ValueError("unknown version")
    return width, height


def _opened(data: bytes) -> tuple[Bits, Coded, list]:
    """A file up to the pixels of its main image, and how to undo its transforms, last one first."""
    bits = Bits(chunk(data))
    width, height = _head(bits)
    undo, inner = [], width
    while bits.take(1):
        kind = bits.take(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.take(3) + 2
            blocks = _entropy_image(bits, -(-inner >> shift), -(-height >> shift), False)
            undo.append(lambda p, f=_undo_predictor if kind == PREDICTOR else _undo_cross_colour, b=blocks, s=shift: f(p, b, s))
        elif kind == SUBTRACT_GREEN:
            undo.append(_undo_subtract_green)
        else:
            size = bits.take(8) + 1
            palette = _join(np.cumsum(_split(_entropy_image(bits, size, 1, False)[0]), 0))
            shift = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append(lambda p, c=palette, s=shift, w=inner: _undo_palette(p, c, s, w))
            inner = -(-inner >> shift)
    return bits, _read_coded(bits, inner, height, True), undo[::-1]


def read(data: bytes) -> np.ndarray:
    """Pixels of a lossless WebP file, height by width."""
    return read_many([data])[0]


def split_files(data: bytes) -> list[bytes]:
    """WebP files that stand end to end."""
    out, at = [], 0
    while at < len(data):
        size = 8 + struct.unpack("<I", data[at + 4 : at + 8])[0]
        out.append(data[at : at + size])
        at += size
    return out


def read_many(files: list[bytes]) -> list[np.ndarray]:
    """Pixels of each file, height by width."""
    out: list[np.ndarray] = []
    for low in range(0, len(files), ABREAST):
        opened = [_opened(f) for f in files[low : low + ABREAST]]
        for pixels, (_, _, undo) in zip(_side_by_side([x[0] for x in opened], [x[1] for x in opened]), opened, strict=True):
            for f in undo:
                pixels = f(pixels)
            out.append(pixels)
    return out


def _side_by_side(streams: list[Bits], heads: list[Coded]) -> list[np.ndarray]:
    """Main images of some files. Each step takes a symbol of every file that goes on; the few longest are then finished one by one."""
    sizes = np.array([h.width * h.height for h in heads])
    plain = np.array([len(h.codes) == 1 and max(c.longest for c in h.codes[0]) <= SHORT for h in heads], bool)
    order = np.flatnonzero(plain)[np.argsort(-sizes[plain], kind="stable")]
    done = np.zeros(len(heads), np.int64)
    out, first = np.zeros(int(sizes[order].sum()), np.uint32), np.zeros(len(heads), np.int64)
    if len(order) >= FEW:
        n = sizes[order]
        start = np.cumsum(n) - n
        first[order] = start
        tables = _tables([c for i in order.tolist() for c in heads[i].codes[0]]).ravel()
        data = b"".join(streams[i].data for i in order) + bytes(8)
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # eight bytes from every byte on
        begin = np.cumsum([0, *(len(streams[i].data) for i in order)])[:-1]
        bit = begin * 8 + np.array([streams[i].at for i in order])
        bits = np.array([heads[i].cache_bits for i in order])
        cache = np.zeros((len(order), 1 << int(bits.max())), np.uint32)
        fold, width = (32 - bits).astype(np.uint64), np.array([heads[i].width for i in order])
        base, at, row, mask = np.arange(len(order)) * 5 << SHORT, np.zeros(len(order), np.int64), np.arange(len(order)), np.uint64((1 << SHORT) - 1)
        near = np.array(NEAR)
        # What goes on stands in `row`, so that arrays of the others need not be cut.
        while len(row) >= FEW:
            v = words[bit[row] >> 3] >> (bit[row] & 7).astype(np.uint64)
            entry = tables[base[row] + (v & mask).astype(np.int64)].astype(np.int64)
            symbol, used = entry & 0xFFF, entry >> 12
            literal = symbol < LITERALS
            some, v = row[literal], v >> used.astype(np.uint64)
            if len(some):
                pixel, w, taken = symbol[literal] << 8, v[literal], used[literal]
                for k, up in ((1, 16), (2, 0), (3, 24)):
                    e = tables[base[some] + (k << SHORT) + (w & mask).astype(np.int64)].astype(np.int64)
                    w, taken = w >> (e >> 12).astype(np.uint64), taken + (e >> 12)
                    pixel |= (e & 0xFFF) << up
                _put(out, cache, some, start[some] + at[some], pixel.astype(np.uint32), fold, bits)
                at[some] += 1
                bit[some] += taken
            if not literal.all():
                cached = symbol >= LITERALS + LENGTHS
                if cached.any():
                    some = row[cached]
                    pixel = cache[some, symbol[cached] - LITERALS - LENGTHS]
                    _put(out, cache, some, start[some] + at[some], pixel, fold, bits)
                    at[some] += 1
                    bit[some] += used[cached]
                copied = ~literal & ~cached
                if copied.any():
                    some = row[copied]
                    bit[some] += used[copied]
                    length, bit[some] = _values(words, bit[some], symbol[copied] - LITERALS)
                    e = tables[base[some] + (4 << SHORT) + (words[bit[some] >> 3] >> (bit[some] & 7).astype(np.uint64) & mask).astype(np.int64)].astype(np.int64)
                    far, bit[some] = _values(words, bit[some] + (e >> 12), e & 0xFFF)
                    close = near[np.minimum(far, len(near)) - 1]
                    far = np.where(far > len(near), far - len(near), np.maximum(1, close[:, 0] + close[:, 1] * width[some]))
                    if (far > at[some]).any() or (at[some] + length > n[some]).any():
                        raise ValueError("a back-reference leaves the image")
                    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                    to = np.repeat(start[some] + at[some], length) + step
                    source = np.repeat(start[some] + at[some] - far, length) + step % np.repeat(far, length)
                    _put(out, cache, np.repeat(some, length), to, out[source], fold, bits)
                    at[some] += length
            row = row[at[row] < n[row]]
        done[order] = at
        for k, i in enumerate(order.tolist()):
            streams[i].at = int(bit[k] - begin[k] * 8)
    images = []
    for i, (stream, head) in enumerate(zip(streams, heads, strict=True)):
        have = out[first[i] : first[i] + done[i]]
        images.append(have.reshape(head.height, head.width) if done[i] == sizes[i] else _pixels(stream, head, have.tolist()))
    return images


def _tables(codes: list[Code]) -> np.ndarray:
    """A row for each code, by the next SHORT bits: length << 12 | symbol."""
    several = [c for c in codes if c.only is None]
    out = np.empty((len(codes), 1 << SHORT), np.uint16)
    if several:
        size, symbol = np.concatenate([c.size for c in several]), np.concatenate([c.used for c in several])
        order = np.argsort(np.repeat(np.arange(len(several)) << 4, [len(c.used) for c in several]) | size, kind="stable")  # symbols rise already
        size = size[order]
        entry = (size << 12 | symbol[order]).astype(np.uint16)
        out[[k for k, c in enumerate(codes) if c.only is None]] = np.repeat(entry, np.int64(1) << SHORT - size).reshape(len(several), -1)[:, _mirrored(SHORT)]
    for k, c in enumerate(codes):
        if c.only is not None:
            out[k] = c.only
    return out


def _put(out: np.ndarray, cache: np.ndarray, file: np.ndarray, to: np.ndarray, pixel: np.ndarray, fold: np.ndarray, bits: np.ndarray) -> None:
    """Write pixels, and put them in their files' caches, the last of equal places staying."""
    out[to] = pixel
    if cache.shape[1] > 1:
        place = ((pixel.astype(np.uint64) * np.uint64(CACHE_FACTOR)) & np.uint64(0xFFFFFFFF)) >> fold[file]
        cache[file, np.where(bits[file] > 0, place, 0).astype(np.int64)] = pixel


def _values(words: np.ndarray, bit: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths or distances by their prefixes and the bits that follow, and the bits after these."""
    extra = np.maximum(0, prefix - 2 >> 1)
    more = (words[bit >> 3] >> (bit & 7).astype(np.uint64)).astype(np.int64) & (1 << extra) - 1
    return np.where(prefix < 4, prefix + 1, (2 + (prefix & 1) << extra) + more + 1), bit + extra


def code_lengths(counts: np.ndarray, most: int = SHORT) -> np.ndarray:
    """Lengths of complete prefix codes, none over `most`, for rows of counts of symbols: what a symbol's share asks for, rounded up; room that is left shortens the codes that were rounded most. A single symbol has 1."""
    counts = np.atleast_2d(counts)
    used = counts > 0
    share = counts / np.maximum(1, counts.sum(1, keepdims=True))
    with np.errstate(divide="ignore"):
        lengths = np.where(used, np.clip(np.ceil(-np.log2(share) - 1e-12), 1, most), 0).astype(np.int64)
    weight = np.where(used, np.int64(1) << most - lengths, 0)
    room = (1 << most) - weight.sum(1)
    order = np.argsort(np.where(used, -share * (1 << lengths), 9), axis=1, kind="stable")  # most rounded first
    ahead = np.cumsum(np.take_along_axis(weight, order, 1), 1)
    shorter = np.zeros_like(used)
    np.put_along_axis(shorter, order, (ahead <= np.maximum(room, 0)[:, None]) & (np.take_along_axis(lengths, order, 1) > 1), 1)
    lengths -= shorter
    several = used.sum(1) > 1
    room = (1 << most) - np.where(used, np.int64(1) << most - lengths, 0).sum(1)
    for i in np.flatnonzero(several & (room != 0)).tolist():
        row, left = lengths[i], int(room[i])
        mine = np.flatnonzero(used[i])
        mine = mine[np.lexsort((-counts[i, mine], -row[mine]))].tolist()
        n = row[mine].tolist()
        while left < 0:  # too many long codes were cut to `most`: lengthen the rarest of those that are shorter
            k = max((k for k in range(len(n)) if n[k] < most), key=lambda k: (n[k], -counts[i, mine[k]]))
            left += 1 << most - n[k] - 1
            n[k] += 1
        while left:  # shorten the longest that fit, the most frequent first
            for k in range(len(n)):
                if n[k] > 1 and 1 << most - n[k] <= left:
                    left -= 1 << most - n[k]
                    n[k] -= 1
                    break
            else:
                raise AssertionError("a code can't be completed")
        row[mine] = n
    return lengths


def canonical(lengths: np.ndarray, most: int = SHORT) -> np.ndarray:
    """Codes of symbols by rows of lengths, to be written lowest bit first."""
    order = np.argsort(np.where(lengths > 0, lengths, most + 1), axis=-1, kind="stable")
    size = np.where(lengths > 0, np.int64(1) << most - np.maximum(lengths, 0), 0)
    sorted_size = np.take_along_axis(size, order, -1)
    codes = np.zeros_like(lengths)
    np.put_along_axis(codes, order, np.where(sorted_size > 0, _mirrored(most)[np.minimum(np.cumsum(sorted_size, -1) - sorted_size, (1 << most) - 1)], 0), -1)
    return codes


#: The writer's one code for code lengths: 4 bits for lengths up to 13, 5 for the rest and for runs of zeros.
_OF_LENGTHS = np.array([4] * 14 + [5, 5, 0, 5, 5])
_BITS_OF = [f"{c:0{n}b}" if n else "" for c, n in zip(canonical(_OF_LENGTHS).tolist(), _OF_LENGTHS.tolist(), strict=True)]
_HEAD = "".join(["1", *(f"{int(_OF_LENGTHS[k]):03b}" for k in reversed(CODE_LENGTH_ORDER)), "1111", "0"])
_ZEROS = [""] + [f"{n - 11:07b}{_BITS_OF[18]}" if n >= 11 else f"{n - 3:03b}{_BITS_OF[17]}" if n >= 3 else "" for n in range(1, 139)]


def _put_code(lengths: np.ndarray) -> tuple[int, int]:
    """A prefix code's lengths as (number, bits), lowest bit first: zeros in runs, all else one by one."""
    used = np.flatnonzero(lengths)
    if len(used) == 1 and used[0] < 256:
        return 1 | 1 << 2 | int(used[0]) << 3, 11
    parts, before = [], -1
    for k, n in zip(used.tolist(), lengths[used].tolist(), strict=True):
        run, before = k - before - 1, k
        while run:
            step = min(run, 138)
            if step < 3:
                parts += [_BITS_OF[0]] * step
            else:
                parts.append(_ZEROS[step])
            run -= step
        parts.append(_BITS_OF[n])
    wide = len(parts) >= 258
    parts.reverse()
    text = "".join([*parts, f"{len(parts) - 2:0{10 if wide else 8}b}", "100" if wide else "011", _HEAD])
    return int(text, 2), len(text)


def _prefix(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix, following bits and their number of lengths or distances."""
    v = value - 1
    high = np.where(v > 0, np.log2(np.maximum(v, 1)).astype(np.int64), 0)
    extra = np.where(v < 4, 0, high - 1)
    return np.where(v < 4, v, 2 * high + (v >> np.maximum(high - 1, 0) & 1)), v & (1 << extra) - 1, extra


def _bytes_of(pixels: np.ndarray) -> list[np.ndarray]:
    """Channels alpha, red, green, blue as uint32."""
    return [pixels >> np.uint32(k) & np.uint32(255) for k in (24, 16, 8, 0)]


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Difference of each channel."""
    low = np.uint32(0x00FF00FF)
    return ((a | ~low) - (b & low) & low) | ((a | low) - (b & ~low) & ~low)


def _bits_for(pixels: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """About the bits of each image's pixels as literals, with their codes."""
    total = np.zeros(n)
    for c in _bytes_of(pixels):
        h = np.bincount(owner * 256 + c, minlength=n * 256).reshape(n, 256).astype(float)
        size = h.sum(1)
        total += size * np.log2(np.maximum(size, 1)) - (h * np.log2(np.maximum(h, 1))).sum(1) + 5 * (h > 0).sum(1)
    return total


def _copies(pixels: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first pixel, length, distance) of back-references, longest runs from left to right: each to the last place with the same LEAST_COPY pixels."""
    n = len(pixels) - LEAST_COPY + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none
    key = owner[:n].astype(np.uint64)
    for k in range(LEAST_COPY):
        key = (key ^ pixels[k : n + k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    before = np.full(n, -1)
    same = key[order][1:] == key[order][:-1]
    before[order[1:][same]] = order[:-1][same]
    place = np.arange(n)
    good = (before >= 0) & (place + LEAST_COPY <= ends[owner[:n]]) & (owner[np.maximum(before, 0)] == owner[:n])
    for k in range(LEAST_COPY):
        good &= pixels[np.maximum(before, 0) + k] == pixels[k : n + k]
    far = np.where(good, place - before, 0)
    lead = good & ~np.concatenate([[False], (far[1:] == far[:-1]) & (owner[1:n] == owner[: n - 1])])
    last = good & ~np.concatenate([(far[1:] == far[:-1]) & (owner[1:n] == owner[: n - 1]), [False]])
    found, at = [], 0
    for a, b, d in zip(np.flatnonzero(lead).tolist(), np.flatnonzero(last).tolist(), far[lead].tolist(), strict=True):
        a = max(a, at)
        while a <= b:
            length = min(b - a + LEAST_COPY, 4096)
            found.append((a, length, d))
            a = at = a + length
    return tuple(np.array(found, np.int64).reshape(-1, 3).T)


def _shared(counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Images whose red, blue and alpha, and those whose green too, are cheaper in one code; their counts are added up."""

    def bits(h: np.ndarray) -> np.ndarray:
        size = h.sum(1)
        return size * np.log2(np.maximum(size, 1)) - (h * np.log2(np.maximum(h, 1))).sum(1) + 5 * (h > 0).sum(1)

    green, *others = counts[:4]
    three = sum(others)
    apart, joint = sum(map(bits, others)), bits(three)
    four = three + green[:, :256]
    all_shared = ~green[:, 256:].any(1) & (bits(four) < bits(green) + np.minimum(apart, joint))
    shared = all_shared | (joint < apart)
    total = np.where(all_shared[:, None], four, three)
    for h in others:
        h[shared] = total[shared]
    green[all_shared, :256] = total[all_shared]
    return shared, all_shared


def _cache_hits(pixels: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cache place of every pixel, and whether the last pixel before it with that place in its image is the same."""
    place = ((pixels.astype(np.uint64) * np.uint64(CACHE_FACTOR)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - CACHE_BITS)
    slot = owner.astype(np.int64) << CACHE_BITS | place.astype(np.int64)
    order = np.argsort(slot, kind="stable")
    hit = np.zeros(len(pixels), bool)
    hit[order[1:]] = (slot[order][1:] == slot[order][:-1]) & (pixels[order][1:] == pixels[order][:-1])
    return place.astype(np.int64), hit


def _coded(images: list[np.ndarray], main: bool) -> list[tuple[int, int]]:
    """Each image of pixels as entropy-coded bits: (number, how many), with back-references and, where it pays, a cache."""
    n = np.array([len(x) for x in images])
    pixels, owner, ends = np.concatenate(images), np.repeat(np.arange(len(n)), n), np.cumsum(n)
    a, length, far = _copies(pixels, owner, ends)
    inside = np.zeros(len(pixels) + 1, np.int64)
    np.add.at(inside, a, 1)
    np.add.at(inside, a + length, -1)
    single = np.cumsum(inside[:-1]) == 0
    place, hit = _cache_hits(pixels, owner)
    hit &= single
    cached = np.bincount(owner[hit], minlength=len(n)) >= LEAST_HITS
    hit &= cached[owner]
    at = np.concatenate([np.flatnonzero(single), a])
    order = np.argsort(at, kind="stable")
    of = owner[at][order]
    is_copy = (np.arange(len(at)) >= len(at) - len(a))[order]
    at = at[order]
    rank = np.cumsum(is_copy) - 1  # of copies, which stand by place
    alpha, red, green, blue = (c.astype(np.int64) for c in _bytes_of(pixels[at]))
    wide = LITERALS + LENGTHS + (1 << CACHE_BITS)
    kind, extra, extra_n = _prefix(length)
    far_kind, far_extra, far_n = _prefix(far + len(NEAR))
    first = np.where(hit[at], LITERALS + LENGTHS + place[at], green)
    if len(a):
        first = np.where(is_copy, LITERALS + kind[np.maximum(rank, 0)], first)
    literal = ~is_copy & ~hit[at]
    sizes = (wide, 256, 256, 256, DISTANCES)
    values = (first, red, blue, alpha, far_kind[np.maximum(rank, 0)] if len(a) else first)
    masks = (np.ones(len(at), bool), literal, literal, literal, is_copy)
    counts = [np.bincount(of[m] * k + v[m], minlength=len(n) * k).reshape(len(n), k) for v, m, k in zip(values, masks, sizes, strict=True)]
    shared, all_shared = _shared(counts)
    for count in counts:
        count[~count.any(1), 0] = 1
    of_red = code_lengths(counts[1])
    lengths = [np.zeros(c.shape, np.int64) for c in counts]
    for c, count in enumerate(counts):
        again = shared if 0 < c < 4 else all_shared if not c else np.zeros(len(n), bool)
        if again.any():
            lengths[c][again, :256] = of_red[again]
        if not again.all():
            lengths[c][~again] = code_lengths(count[~again])
    heads, codes = [], [canonical(x).astype(np.uint64) for x in lengths]
    for i in range(len(n)):
        value, bits = (1 | CACHE_BITS << 1, 5) if cached[i] else (0, 1)
        bits += main
        red = _put_code(lengths[1][i])
        for c in range(5):
            if c == 1 or c and c < 4 and shared[i] or not c and all_shared[i]:
                v, size = red
            else:
                v, size = _put_code(lengths[c][i] if c or cached[i] else lengths[c][i][: LITERALS + LENGTHS])
            value |= v << bits
            bits += size
        heads.append((value, bits))
    for x in lengths:
        x[np.count_nonzero(x, axis=1) == 1] = 0  # a single symbol takes no bits
    code, size = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)

    def add(v: np.ndarray, bits: np.ndarray) -> None:
        nonlocal size
        code[:] |= v.astype(np.uint64) << size.astype(np.uint64)
        size = size + bits

    for c in range(4):
        entry = of * sizes[c] + np.where(masks[c], values[c], 0)
        taken = np.where(masks[c], lengths[c].ravel()[entry], 0)
        add(np.where(taken > 0, codes[c].ravel()[entry], 0), taken)
        if not c and len(a):
            add(np.where(is_copy, extra[np.maximum(rank, 0)], 0), np.where(is_copy, extra_n[np.maximum(rank, 0)], 0))
    if len(a):
        add(np.where(is_copy & (lengths[4][of, values[4]] > 0), codes[4][of, values[4]], 0), np.where(is_copy, lengths[4][of, values[4]], 0))
        add(np.where(is_copy, far_extra[np.maximum(rank, 0)], 0), np.where(is_copy, far_n[np.maximum(rank, 0)], 0))
    total = np.bincount(of, size, len(n)).astype(np.int64)
    n_bytes = total + 7 >> 3
    begin = np.cumsum(n_bytes) - n_bytes
    end = np.cumsum(size)
    bit = end - size - (np.cumsum(total) - total)[of] + begin[of] * 8
    words = np.zeros((int(n_bytes.sum()) >> 3) + 3, np.uint64)
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[starts]] |= np.bitwise_or.reduceat(code << shift, starts)
    over = np.where(shift > 0, code >> (np.uint64(64) - np.maximum(shift, 1)), np.uint64(0))
    words[word[starts] + 1] |= np.bitwise_or.reduceat(over, starts)
    stream = words.tobytes()
    return [(v | int.from_bytes(stream[b : b + k], "little") << bits, bits + t) for (v, bits), b, k, t in zip(heads, begin.tolist(), n_bytes.tolist(), total.tolist(), strict=True)]


def _constant(pixel: int) -> tuple[int, int]:
    """An image of one colour: codes of a single symbol each, no bits for pixels."""
    value, bits = 0, 1
    for v in (pixel >> 8 & 255, pixel >> 16 & 255, pixel & 255, pixel >> 24, 0):
        value |= (5 | v << 3) << bits
        bits += 11
    return value, bits


def _palette_of(pixels: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Colours, packed indices and their width, if there are few colours."""
    colours, index = np.unique(pixels, return_inverse=True)
    if len(colours) > 256:
        return None
    shift = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
    rows = index.reshape(-1, width).astype(np.uint32)
    inner = -(-width >> shift)
    rows = np.pad(rows, ((0, 0), (0, (inner << shift) - width))).reshape(len(rows), inner, 1 << shift)
    packed = (rows << (np.arange(1 << shift, dtype=np.uint32) * np.uint32(8 >> shift))).sum(2, dtype=np.uint32)
    return colours, (np.uint32(BLACK) | packed << np.uint32(8)).ravel(), inner


def _palettes(images: list[np.ndarray], pixels: np.ndarray, owner: np.ndarray, width: int, cost: np.ndarray) -> dict[int, tuple[np.ndarray, int, int, int]]:
    """(indices, colours, number and bits of the coded palette) of the images that a palette makes cheaper than cost. All images' colours are counted, and all palettes coded, together."""
    each = np.sort(owner.astype(np.uint64) << np.uint64(32) | pixels)
    colours = np.bincount((each[np.concatenate([[True], each[1:] != each[:-1]])] >> np.uint64(32)).astype(np.int64), minlength=len(images))
    at = np.flatnonzero(colours <= 256).tolist()
    if not at:
        return {}
    found = [_palette_of(images[i], width) for i in at]
    deltas = [np.concatenate([c[:1], _minus(c[1:], c[:-1])]) for c, _, _ in found]
    parts = [x for (_, index, _), d in zip(found, deltas, strict=True) for x in (index, d)]
    both = _bits_for(np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts]), len(parts)).reshape(-1, 2).sum(1) + 60
    good = np.flatnonzero(both < cost[at]).tolist()
    coded = _coded([deltas[k] for k in good], False) if good else []
    return {at[k]: (found[k][1], len(found[k][0]), *c) for k, c in zip(good, coded, strict=True)}


def write(images: list[np.ndarray], width: int) -> list[bytes]:
    """A lossless WebP file for each array of pixels, whose size is a multiple of width."""
    if not images:
        return []
    n = np.array([len(x) for x in images])
    pixels, owner, first = np.concatenate(images), np.repeat(np.arange(len(n)), n), np.cumsum(n) - np.array([len(x) for x in images])
    place = np.arange(len(pixels)) - first[owner]
    left, top = np.concatenate([pixels[:1], pixels[:-1]]), np.concatenate([pixels[:width], pixels[:-width]])
    edge = np.where(place == 0, np.uint32(BLACK), np.where(place < width, left, top))
    _, red, green, blue = (c.astype(np.uint8).view(np.int8).astype(np.int64) for c in _bytes_of(pixels))
    total = lambda x: np.bincount(owner, x, len(n))
    spread = np.maximum(1, total(green * green) - total(green) ** 2 / n)  # red and blue rise with green by the slope of a least-squares line
    to_red, to_blue = (np.clip(np.rint(32 * (total(c * green) - total(c) * total(green) / n) / spread), -128, 127).astype(np.int64) for c in (red, blue))
    crossed = _minus(pixels, ((to_red[owner] * green >> 5 & 255) << 16 | (to_blue[owner] * green >> 5 & 255)).astype(np.uint32))
    g = pixels >> np.uint32(8) & np.uint32(255)
    choices = [pixels, _minus(pixels, g << np.uint32(16) | g), _minus(pixels, np.where(place % width > 0, left, edge)), _minus(pixels, np.where(place >= width, top, edge)), crossed]
    cost = np.stack([_bits_for(c, owner, len(n)) for c in choices]) + np.array([0, 3, 62, 62, 62])[:, None]
    best = cost.argmin(0)
    chosen = np.choose(best[owner], choices)
    transforms: list[tuple[int, int]] = []
    streams = np.split(chosen, first[1:])
    palettes = _palettes(images, pixels, owner, width, cost[best, np.arange(len(n))])
    for i in range(len(n)):
        k = int(best[i])
        if i in palettes:
            streams[i], n_colours, v, bits = palettes[i]
            transforms.append((1 | PALETTE << 1 | n_colours - 1 << 3 | v << 11, 11 + bits))
            continue
        if k in (2, 3, 4):
            v, bits = _constant(BLACK | (k - 1) << 8 if k < 4 else BLACK | (int(to_blue[i]) & 255) << 8 | int(to_red[i]) & 255)
            transforms.append((1 | (PREDICTOR if k < 4 else CROSS_COLOUR) << 1 | 7 << 3 | v << 6, 6 + bits))
        else:
            transforms.append((1 | SUBTRACT_GREEN << 1, 3) if k else (0, 0))
    out = []
    for i, (value, bits) in enumerate(_coded(streams, True)):
        t, t_bits = transforms[i]
        head = 0x2F | width - 1 << 8 | int(n[i]) // width - 1 << 22 | 1 << 36
        whole, size = head | t << 40 | value << 41 + t_bits, 41 + t_bits + bits  # a 0 bit ends the transforms
        part = whole.to_bytes(size + 7 >> 3, "little")
        pad = len(part) % 2
        out.append(struct.pack("<4sI8sI", b"RIFF", 12 + len(part) + pad, b"WEBPVP8L", len(part)) + part + bytes(pad))
    return out
